"""Column expressions; all of them stay inside Catalyst but the byte packing."""
