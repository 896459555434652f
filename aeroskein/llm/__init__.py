"""Training-data operators: extraction, mixing, deduplication, scoring, tokenising and archives.

Nothing outside this package imports it.
"""
