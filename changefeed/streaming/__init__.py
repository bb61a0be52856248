"""Running a change feed as a streaming query with a position log."""
