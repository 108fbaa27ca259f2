"""Filters, aggregates and graph patterns as DataFrame operations."""
