"""Registered queries over the given tables."""

from __future__ import annotations


def _load() -> None:
    from logweir.plans import (  # noqa: F401
        config_queries,
        ingest_queries,
        insight_queries,
        report_queries,
        table_queries,
    )


def all_queries() -> dict:
    from logweir.plans.registry import QUERIES

    _load()
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    from logweir.plans.registry import ORACLES

    _load()
    return dict(ORACLES)
