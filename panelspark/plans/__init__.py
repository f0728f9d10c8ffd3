"""Queries over the supplied test tables, each with its SQL counterpart."""

from importlib import import_module

MODULES = [
    "flagship",
    "calendar_queries",
    "join_queries",
    "window_queries",
    "section_queries",
    "aggregate_queries",
    "evaluation_queries",
    "quality_queries",
    "source_queries",
    "streaming_queries",
    "dataset_queries",
    "market_queries",
]


def load_all():
    """Import every query module and return the registry in definition order."""
    for m in MODULES:
        import_module(f"panelspark.plans.{m}")
    from panelspark.plans.registry import QUERIES

    return QUERIES
