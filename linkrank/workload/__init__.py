"""The registered queries over the given tables, and their SQL counterparts."""

from linkrank.workload.oracle import oracle_sql
from linkrank.workload.queries import queries

__all__ = ["oracle_sql", "queries"]
