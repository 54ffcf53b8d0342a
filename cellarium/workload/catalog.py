"""All registered queries."""

from cellarium.workload import comparing, filtering, jobs, mutations, scans, streams  # noqa: F401
from cellarium.workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
