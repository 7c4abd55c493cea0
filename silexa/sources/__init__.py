"""Readers: tables, JSONL files and the parsers of raw documents."""
