"""Structured Streaming entry points (landing-folder ingest)."""

from navlib.streaming.landing import follow_landing

__all__ = ["follow_landing"]
