"""Operators of a training-data pipeline: scoring, near duplicates, licences, toxicity,
quality rules, repeated passages, mixing, vector search, encoding, personal data,
language, periodic runs and token alignment.

Nothing outside this folder imports it; the queries are in ``queries.py``.
"""
