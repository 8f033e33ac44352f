"""All queries of the library proper."""

from __future__ import annotations

from expatlas.plans import aggregates, ingest, relational, science  # noqa: F401
from expatlas.plans.base import ORACLE_SQL, QUERIES  # noqa: F401
