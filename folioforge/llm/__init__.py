"""Training-data operators: tokens, deduplication, quality, mixing, packing, neighbours, language.

Nothing else in the library imports this subpackage.
"""
