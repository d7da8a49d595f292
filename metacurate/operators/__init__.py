"""Filters, joins, aggregations and curation as DataFrame -> DataFrame functions."""
