"""All metrics together, and their stored snapshots."""
