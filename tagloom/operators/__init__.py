"""Relational building blocks: grouping, joins, ranking, cells."""
