"""Whole transformations and end-to-end jobs."""
