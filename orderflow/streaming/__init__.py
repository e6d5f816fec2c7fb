"""Streaming: cumulative metrics, windowed counts, and the stored pipeline."""
