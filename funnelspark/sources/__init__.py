"""Readers: nested JSON pages, dated file drops, header-fuzzy sheets, mapping files, tables."""
