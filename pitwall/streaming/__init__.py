"""Promotion between environments with Structured Streaming."""
