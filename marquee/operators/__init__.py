"""Relational building blocks: filters, dedupe, merge, joins, aggregates, grouping."""
