"""Reusable DataFrame -> DataFrame steps."""
