"""Registered queries over the benchmark tables and their SQL twins."""

from tripweave.workloads import (  # noqa: F401
    calendar_queries,
    city_queries,
    discovery_queries,
    domain_queries,
    item_queries,
    job_queries,
    run_queries,
    source_queries,
    store_queries,
)
from tripweave.workloads.registry import QUERIES, TWINS

__all__ = ["QUERIES", "TWINS"]
