"""Operators for preparing text corpora: sharding, de-duplication, filters, packing.

Nothing else in the library imports this subpackage.
"""
