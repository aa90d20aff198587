"""Registered queries and their SQL counterparts."""

from __future__ import annotations

from campaign_engine.catalog.base import oracles, queries


def load() -> tuple[dict, dict]:
    """Import every catalog module and return (queries, SQL)."""
    from campaign_engine.catalog import (  # noqa: F401
        aggregates,
        campaign,
        cleaning,
        columns,
        metrics,
        models,
        quality,
        sources,
    )

    return dict(queries), dict(oracles)
