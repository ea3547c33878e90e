"""Queries over the test tables: each runs a library operator, most with equivalent SQL beside it."""
