"""Scalar helpers; each returns a Column or a plain string parameter."""
