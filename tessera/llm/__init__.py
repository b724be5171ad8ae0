"""Training-data operators: tokenizing, deduplication, privacy, quality and packing.

Nothing else in the library imports this subpackage.
"""
