"""Operators for training-data corpora: cleaning, deduplication, scoring, packing.

Each module holds one operator with its own general interface; ``queries.py``
holds the thin registered queries.  Nothing else in the library imports this
subpackage.
"""
