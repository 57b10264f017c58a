"""Whole jobs: the load, and the queries bound to the test tables."""
