"""Readers for the four raw tables."""
