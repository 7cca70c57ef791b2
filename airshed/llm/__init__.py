"""Corpus operators for training-data pipelines.

Each module holds one operator with an interface of its own; ``catalog``
registers one query per operator over the driver tables. Nothing outside this
subpackage (and ``corpus_pipeline.py``) imports it.
"""
