"""Composite jobs."""
