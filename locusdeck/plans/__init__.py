"""The query catalogue over the given tables, and its SQL twins."""
