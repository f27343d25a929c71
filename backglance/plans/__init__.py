"""Operators put together for a whole task."""
