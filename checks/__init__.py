"""Registered queries: each operator on the test tables, with the SQL its result must equal."""

from __future__ import annotations

from . import audit, cleaning, groups, identities, linking, quality, reports, risk, search, serving, sources, versions
from .registered import QUERIES, Query

__all__ = ["QUERIES", "Query"]
