"""Relational operators: dedup, chunking, search and verification."""
