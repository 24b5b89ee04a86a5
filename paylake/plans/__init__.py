"""Composed jobs (bronze/silver/gold/labels) and the named query catalog."""
