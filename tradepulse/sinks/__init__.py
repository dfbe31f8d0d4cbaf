"""Sinks: append topics, routed topics, window tables, keyed tables."""
