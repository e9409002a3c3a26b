"""Readers, odd text formats and writers."""
