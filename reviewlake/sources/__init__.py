"""Reading and writing of review files, page snapshots and tables."""
