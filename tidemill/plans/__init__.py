"""Whole jobs: the location roll-up, the incremental load, and the query catalogue."""
