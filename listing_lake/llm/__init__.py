"""Operators for training data at scale: filters, de-duplication, mixing, sharding and packing.

Nothing else in the library imports this subpackage.
"""
