"""Readers for files, JDBC tables and landed API pages."""
