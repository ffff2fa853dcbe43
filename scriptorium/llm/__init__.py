"""Training-data operators: decontamination, chat formatting, packing,
near-duplicates, token files, web archives, quality, search, toxicity, URLs,
languages, collocations, ranked lexical search.

Nothing outside this package imports it; its queries are registered by
``__spark_entry__.py`` when the package is present.
"""
