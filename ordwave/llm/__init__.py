"""Operators for preparing language-model training data, and their queries.

Nothing outside this package imports it except ``__spark_entry__`` (guarded)
and ``corpus_pipeline``.
"""
