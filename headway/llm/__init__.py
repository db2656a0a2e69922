"""Operators for preparing training data: filters, duplicate search, archives, scoring and packing."""
