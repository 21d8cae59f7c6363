"""Readers for records, rules and lists; writers for tables and reports."""
