"""All queries of the core, with the SQL they are checked against."""

from __future__ import annotations

from . import analytics, conversions, records, resolution, warehouse

FLAGSHIP = "q_profile_latest"
_MODULES = (analytics, conversions, resolution, warehouse, records)


def queries() -> dict:
    return {k: v for m in _MODULES for k, v in m.queries().items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in _MODULES for k, v in m.oracle_sql().items()}
