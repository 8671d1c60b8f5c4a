"""Queries and publication."""
