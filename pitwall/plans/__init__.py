"""Staging, marts and reports."""
