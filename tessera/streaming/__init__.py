"""Streaming use of the narrow operators."""
