"""Structured Streaming plans: page files to numbered pairs, link dedup."""
