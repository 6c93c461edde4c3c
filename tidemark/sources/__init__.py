"""Readers: tables, key ranges, text, CSV and encrypted line files."""
