"""Relational operators: typing, audits, windows, joins, labels, stats, ordering."""
