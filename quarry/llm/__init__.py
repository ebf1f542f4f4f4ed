"""Operators for preparing training data: duplicates, filters, mixing, packing, encodings."""
