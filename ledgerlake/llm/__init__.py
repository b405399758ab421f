"""Operators of a training-data pipeline over documents, pages and labels.

Nothing outside this package imports it. ``queries.QUERIES`` lists one query per
operator; ``corpus_pipeline.py`` at the repository top chains five of them.
"""
