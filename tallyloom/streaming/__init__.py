"""Structured Streaming forms of scoring, quotas and drift."""
