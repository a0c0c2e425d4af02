"""Whole jobs (features, train, score) and the queries binding them to the test tables."""
