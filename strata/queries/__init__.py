"""Queries over the standard tables, each with the SQL that gives the same rows where there is one."""

from strata.queries.registry import ORACLES, QUERIES

from strata.queries import batch, merges, streams, workloads  # noqa: E402,F401  (they register themselves)

__all__ = ["ORACLES", "QUERIES"]
