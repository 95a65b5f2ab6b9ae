"""Operators for large text corpora: classifiers, near-duplicate joins, search, tokens, archives, packing."""
