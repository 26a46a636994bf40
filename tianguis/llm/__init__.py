"""Operators for training-data pipelines over text, vector and url tables.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.  Each module
holds one operator with a general interface; ``queries`` has the thin queries.
"""
