"""Corpus sources (text files, text columns of tables) and table sinks."""

from charloom.sources.text import corpus_lines, read_table, read_text_lines, write_table

__all__ = ["corpus_lines", "read_table", "read_text_lines", "write_table"]
