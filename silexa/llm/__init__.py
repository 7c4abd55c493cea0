"""Operators for training data: splitting, packing, similarity, duplicates, tokens, leaks, spam."""
