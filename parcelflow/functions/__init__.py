"""Scalar functions: Column in, Column out. No Python UDFs."""
