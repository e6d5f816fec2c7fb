"""Batch and streaming analytics over retail order transactions, on Spark."""
