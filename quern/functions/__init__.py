"""Scalar functions and image kernels."""
