"""Operators for preparing text and vector training data at cluster scale.

Nothing outside this subpackage imports it; removing the folder leaves the
rest of the library intact.
"""
