"""Structured Streaming jobs over metric points."""
