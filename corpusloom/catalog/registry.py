"""All registered queries."""

from __future__ import annotations

from importlib import import_module

_MODULES = (
    "text_queries", "corpus_queries", "explore_queries", "metric_queries", "feature_queries", "model_queries",
    "file_queries",
)


def _merged(attribute: str) -> dict:
    out: dict = {}
    for name in _MODULES:
        out.update(getattr(import_module(f"{__package__}.{name}"), attribute))
    return out


def queries() -> dict:
    return _merged("QUERIES")


def oracle_sql() -> dict:
    return _merged("ORACLE")
