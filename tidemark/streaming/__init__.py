"""Structured Streaming jobs: exactly-once loading and incremental snapshots."""
