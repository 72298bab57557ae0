"""Operators of a training-data pipeline: archives, scoring, near-duplicates, search, packing, encoding.

Nothing else in the library imports this subpackage; ``__spark_entry__`` adds its queries when it
is present.
"""
