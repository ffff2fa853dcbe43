"""Corpus folders, chat JSONL, tables and dataset sinks."""
