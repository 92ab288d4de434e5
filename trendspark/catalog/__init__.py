"""Registered queries over the given tables, each with its SQL twin where SQL can say it."""

from trendspark.catalog.base import REGISTRY, Entry

__all__ = ["REGISTRY", "Entry", "load"]


def load() -> dict[str, Entry]:
    """Import every query module and return the registry."""
    from trendspark.catalog import (  # noqa: F401
        aggregate,
        cleaning,
        core,
        learning,
        pages,
        rebalance,
        scalar,
        sources,
        statistics,
        validation,
    )

    return REGISTRY
