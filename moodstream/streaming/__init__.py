"""Structured Streaming jobs: scoring, running counts, windowed counts, snapshots."""
