"""Structured Streaming jobs over clicks and contacts."""
