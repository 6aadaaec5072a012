"""Registered queries (Spark) and their DuckDB counterparts, keyed by the same names."""

from __future__ import annotations

from registry.base import Query


def all_queries() -> dict[str, Query]:
    from registry import checks, gating, marts, serving, storage, streams

    merged: dict[str, Query] = {}
    for module in (marts, serving, gating, checks, storage, streams):
        overlap = merged.keys() & module.QUERIES.keys()
        if overlap:
            raise ValueError(f"query names registered twice: {sorted(overlap)}")
        merged.update(module.QUERIES)
    return merged
