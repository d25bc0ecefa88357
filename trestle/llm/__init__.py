"""Operators for training-data pipelines: tokens, filters, near-duplicates, search, packing.

Nothing outside this package imports it; ``__spark_entry__`` adds its queries when it is present.
"""
