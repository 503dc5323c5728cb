"""Structured Streaming forms of the loads (T01, T02) and of the daily HR metric."""
