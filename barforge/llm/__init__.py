"""Operators for preparing training text: near-duplicates, digests, tokens, quality, secrets, packing.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
