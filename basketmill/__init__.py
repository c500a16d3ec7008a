"""Retail analytics as Spark DataFrame jobs: raw lines, cleaned lines, result tables."""
