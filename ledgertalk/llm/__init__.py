"""Operators for preparing training data at scale, one module each.

Nothing else in the library imports this package.
"""
