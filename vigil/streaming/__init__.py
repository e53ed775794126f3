"""Structured Streaming replay of reviews."""
