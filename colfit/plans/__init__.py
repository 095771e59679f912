"""Queries over the test tables, each with the SQL that must give the same rows."""

from colfit.plans import (  # noqa: F401
    clustering,
    curves,
    dense,
    functions,
    linkage,
    networks,
    preparation,
    supervised,
    trees,
    wide,
)
from colfit.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
