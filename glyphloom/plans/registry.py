"""All registered queries of the library."""

from __future__ import annotations

from glyphloom.plans import contracts, curation, evidence, factory, relational  # noqa: F401  (they register)
from glyphloom.plans.base import QUERIES, SQL


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
