"""Staging of the change stream, and the compaction cycle that drains it."""
