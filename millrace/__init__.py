"""Batch and streaming analytics operators written as plain Spark DataFrame code."""
