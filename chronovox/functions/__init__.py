"""Scalar functions and guarded arithmetic."""
