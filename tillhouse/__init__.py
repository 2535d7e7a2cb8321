"""Retail warehouse models, metrics and checks as Spark DataFrame jobs."""
