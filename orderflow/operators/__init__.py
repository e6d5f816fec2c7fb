"""Metrics, time windows and exploration over processed transactions."""
