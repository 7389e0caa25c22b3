"""Operators of a training-data pipeline, each in a module of its own.

Nothing outside this package (and ``corpus_pipeline.py``) imports it.
"""
