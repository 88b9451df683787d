"""Retail analytics marts as PySpark DataFrame jobs."""
