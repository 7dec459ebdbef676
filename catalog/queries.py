"""Imports every module that registers queries."""

from catalog import api, filters, ordering, projections, relations, sources  # noqa: F401
