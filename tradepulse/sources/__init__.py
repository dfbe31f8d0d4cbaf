"""Feeds and snapshots."""
