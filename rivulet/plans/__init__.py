"""Whole jobs put together from the operators: loads into bronze, and the personnel dimension."""
