"""Named queries over the driver's tables, each beside its SQL twin."""

from rillflow.catalog import (  # noqa: F401
    documents,
    relational,
    reports,
    storage,
    streams,
    timeline,
    warehouse,
    widecolumn,
)
from rillflow.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
