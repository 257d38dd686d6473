"""The operators as queries over the star-schema tables."""

from touchline.workload import scalar_queries, table_queries  # noqa: F401
from touchline.workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
