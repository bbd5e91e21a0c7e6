"""Indicator jobs. Each takes tables in their published layout and returns tidy tables."""
