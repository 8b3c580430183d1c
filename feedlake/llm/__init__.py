"""Operators for preparing training data: filters, packing, search, encoding, scores, near copies."""
