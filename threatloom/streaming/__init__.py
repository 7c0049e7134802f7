"""Structured Streaming jobs over alerts and events."""
