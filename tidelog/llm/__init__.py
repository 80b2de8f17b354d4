"""Operators for training-data corpora: near duplicates, filters, models, sharding and packing.

Nothing outside this subpackage imports it; ``queries.py`` lists what is registered.
"""
