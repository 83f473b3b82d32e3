"""Operators for training-data pipelines: near-duplicates, filters, packing, sampling, scoring.

Each module holds one operator with its general interface; ``queries`` derives
the registered ``opN_*`` queries from them.  Nothing outside this folder (and
``corpus_pipeline.py``) imports it.
"""
