"""Structured Streaming jobs: staging, golden upserts and refreshed metrics."""
