"""Readers: whole files, fixed-length records, CSV and text lines."""
