"""Registered queries over the given tables."""

from . import rules, runs, stages  # noqa: F401  register the rules, parts of runs and the end-to-end runs
from .queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
