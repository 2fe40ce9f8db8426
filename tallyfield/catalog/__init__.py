"""Registered queries: every operator on the given tables, with its SQL check where SQL can say it."""

from .registry import ORACLES, QUERIES
from . import clustering, explore, job_runs, modeling, prepare, scores, storage  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
