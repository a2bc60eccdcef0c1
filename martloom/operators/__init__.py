"""Operators over whole frames: joins, sinks, quality checks."""
