"""Operators for large training-data pipelines.

Nothing else in the package imports this subpackage.  Each module holds one
operator with its own general interface; ``queries`` applies the operators to
the driver tables.
"""
