"""Every query of the library: name to callable, and name to SQL."""

from __future__ import annotations

from fleethealth.plans import queries_outlook, queries_series, queries_sources, queries_telemetry, registry

MODULES = (queries_telemetry, queries_series, queries_outlook, queries_sources)


def queries() -> dict[str, registry.Query]:
    return dict(registry.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(registry.SQL)
