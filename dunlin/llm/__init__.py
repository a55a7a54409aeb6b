"""Operators for preparing training text: quality, duplicates, packing, archives."""
