"""Registered queries over the given tables, with the SQL each one is compared to."""

from massloom.catalog import registry

__all__ = ["registry"]
