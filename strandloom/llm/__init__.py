"""Operators for large training-data pipelines.

Nothing outside this package imports it: the rest of the library works with
the folder removed.
"""
