"""The same work on arriving files."""
