"""Operators of a training-data pipeline: deduplication, filters, extraction and packing of text.

Nothing outside this package and ``corpus_pipeline.py`` imports it.
"""
