"""File-source streams."""
