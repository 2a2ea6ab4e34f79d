"""Reading change records and document tables."""
