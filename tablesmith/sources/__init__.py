"""Readers: exported CSV, mapping files, raw text rows, SQL and catalog sources."""
