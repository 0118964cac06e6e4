"""Readers and writers; every reader states its schema."""
