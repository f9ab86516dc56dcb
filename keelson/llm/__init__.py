"""Operators and queries for preparing training text.

Nothing else in the library imports this subpackage. ``queries.QUERIES`` and
``queries.ORACLES`` are what ``__spark_entry__.py`` registers when present.
"""
