"""Retail listing and order analytics as Spark DataFrame jobs."""
