"""Constituent analytics for membership and fundraising organisations, written as Spark jobs."""

__version__ = "0.1.0"
