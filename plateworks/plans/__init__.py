"""Registered queries: operators applied to the driver's tables, with SQL of the same rows."""

from . import catalog, extended  # noqa: F401
