"""Distributed building blocks: skew-safe joins, global ranks, merges, checks, tables."""
