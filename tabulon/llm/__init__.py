"""Operators of a training-data pipeline: cleaning, matching, scoring, packing and storing text.

Nothing else in the library imports this subpackage.
"""
