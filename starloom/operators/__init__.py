"""Reusable DataFrame operators: quantiles, winsorizing, imputing, dedup, joins."""
