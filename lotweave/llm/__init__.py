"""Operators for preparing large text corpora: mixing, scoring, deduplication, formatting, search, counting, packing.

Nothing else in the package imports this subpackage.
"""
