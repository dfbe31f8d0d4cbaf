"""Streaming jobs and their stateful steps."""
