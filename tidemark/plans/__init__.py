"""Compositions of operators, and the queries that show each one on the shared test tables."""
