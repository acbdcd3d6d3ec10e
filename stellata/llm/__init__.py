"""Operators of a training-data pipeline on Spark: archives, mixing, URL verdicts,
deduplication, secret scans, nearest neighbours, tokenising and toxicity.

Nothing else in the library imports this subpackage.
"""
