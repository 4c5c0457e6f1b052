"""Operators for preparing training text: deduplication, filtering, privacy and packing.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
