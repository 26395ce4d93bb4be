"""Scoring of streaming tables."""
