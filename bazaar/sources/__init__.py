"""Readers: driver test tables, medallion layer tables and stream sources."""
