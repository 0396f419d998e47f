"""Corpus operators for training-data preparation.

Nothing else in the library imports this subpackage. Each module holds one
operator with its own general interface; ``queries`` registers the thin
``opN_<name>`` queries on the driver tables.
"""
