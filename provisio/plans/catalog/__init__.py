"""All registered queries by family."""

from provisio.plans.catalog import (  # noqa: F401
    audit, book, cleaning, features, history, loss, metrics, portfolio, reports, scalars, scoring, sources, streams,
    training, trends, woe,
)
from provisio.plans.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
