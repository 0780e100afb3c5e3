"""Relational building blocks: tokens, vocabulary, codes, offsets, windows, sampling."""
