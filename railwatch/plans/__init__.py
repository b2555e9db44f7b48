"""Whole jobs made of the operators, and the queries over the given tables."""
