"""Operators of a training-data pipeline over documents and web pages.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
``queries`` holds the registered queries, ``oracles`` their SQL.
"""
