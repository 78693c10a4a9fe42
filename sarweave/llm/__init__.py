"""Training-data operators: deduplication, filters, mixing and sharding.

Nothing else in the library imports this subpackage.
"""
