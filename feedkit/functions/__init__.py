"""Scalar functions as native Columns."""
