"""Readers and writers of transactions."""
