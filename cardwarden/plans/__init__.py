"""Whole jobs: the full refresh, the warehouse it fills and the queries that read it."""
