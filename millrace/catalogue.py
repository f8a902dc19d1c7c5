"""All queries of the engine."""

from __future__ import annotations

from millrace.plans import boilerplate, dashboards, fields, payloads, postings, sourcing, text  # noqa: F401  they register their queries
from millrace.registry import ORACLE_SQL, QUERIES  # noqa: F401
