"""Sinks for batches and streams."""
