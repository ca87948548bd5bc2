"""Operators for preparing training text: filters, scans, duplicate search and token output."""
