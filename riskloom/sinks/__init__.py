"""Batch and stream writers."""
