"""Whole jobs in batch form, and the registry of queries with their SQL twins."""
