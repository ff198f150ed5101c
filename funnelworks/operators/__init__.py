"""Reusable DataFrame operators (contracts, audits, joins, quality checks)."""
