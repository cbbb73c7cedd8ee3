"""Operators for training-data pipelines: text quality, extraction, deduplication, mixing and binary output.

Nothing outside this folder imports it except the guarded registration in ``__spark_entry__.py`` and
``corpus_pipeline.py``. ``registry`` lists the queries and their SQL.
"""
