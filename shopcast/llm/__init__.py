"""Operators for preparing training corpora.

Ten operators on ``documents``, ``pages``, ``benchmark`` and ``labels``; the
registered queries are in ``llm.catalog``.  Nothing outside this subpackage
(but the guarded part of ``__spark_entry__`` and ``corpus_pipeline``)
imports it.
"""
