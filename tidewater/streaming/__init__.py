"""Structured Streaming jobs: topics to bronze, bronze to silver and quarantine."""
