"""Incremental versions of the daily and half-day totals."""
