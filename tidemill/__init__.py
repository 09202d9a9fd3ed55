"""Batch lakehouse jobs written as Spark DataFrame functions."""
