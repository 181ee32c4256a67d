"""Operators for preparing training data: scans, joins, scoring and mixing over whole corpora."""
