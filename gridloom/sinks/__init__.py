"""Writers: CSV, reports, class-partitioned tables and labelled CSV."""
