"""Structured Streaming variants of the stateless per-row steps."""
