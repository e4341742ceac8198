"""Reports, global ordering helpers and the query catalogue."""
