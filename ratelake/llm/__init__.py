"""Operators for preparing language-model training data, their queries and SQL.

Nothing outside this folder, ``tests/llm`` and ``corpus_pipeline.py`` imports it.
"""
