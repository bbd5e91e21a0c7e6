"""Operators for training data: search, decontamination, deduplication, packing, sharding, formatting.

Nothing outside this subpackage imports it. ``queries`` binds the operators to the benchmark tables.
"""
