"""The operators put together: from page snapshots to a classified table."""
