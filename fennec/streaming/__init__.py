"""Structured Streaming scoring with fitted state."""
