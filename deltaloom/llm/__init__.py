"""Operators of a training-data pipeline: filters, joins, scans, scoring and mixing of text corpora."""
