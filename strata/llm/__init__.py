"""Operators of a training-data pipeline: duplicates, extraction, archives, languages, packing, scans, filters.

Nothing outside this folder imports it. Queries over the standard tables are in ``queries.py``.
"""
