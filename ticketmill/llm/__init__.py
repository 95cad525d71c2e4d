"""Operators for training data: deduplication, filters, tokens and packing.

Nothing outside this subpackage imports it. Each module holds one operator with its own
interface; ``queries`` derives the registered results from them.
"""
