"""Operators for preparing training text at scale: one module per operator, ``queries`` registers them.

Nothing outside this package imports it, apart from the guarded hook in ``__spark_entry__``.
"""
