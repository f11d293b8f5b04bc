"""Operators for preparing training text: scoring, filtering, de-duplication and packing.

Nothing else in the library imports this package.
"""
