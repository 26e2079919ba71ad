"""Joins, aggregates, metrics, checks, merges and reports."""
