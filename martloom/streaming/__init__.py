"""Change capture: from a feed of change events to lake tables."""
