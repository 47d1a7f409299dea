"""Training-data operators: tokenising, scoring, deduplication, filtering and cleaning of document tables.

Nothing outside this package imports it, so it can be removed as a whole.
"""
