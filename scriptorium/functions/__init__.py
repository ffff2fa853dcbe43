"""Column-level building blocks: text rules, tokenizers, chat templates."""
