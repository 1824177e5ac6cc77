"""All registered queries (SQL-checked catalog + model/stream queries without an oracle)."""

from __future__ import annotations

from riskloom.plans import catalog


def _load() -> dict:
    # importing registers the model and streaming queries into the same registry
    from riskloom.plans import evaluation, io_roundtrips, modeling, monitoring, saved_pipelines  # noqa: F401
    from riskloom.streaming import audit  # noqa: F401

    return catalog.REGISTRY


def all_queries() -> dict:
    return {name: fn for name, (fn, _sql) in _load().items()}


def all_oracles() -> dict:
    return {name: sql for name, (_fn, sql) in _load().items() if sql}
