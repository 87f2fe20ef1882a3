"""Readers for files, tables and databases."""
