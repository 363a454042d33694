"""Operators for preparing training data, with their queries and SQL counterparts."""

import sys

from pyspark import cloudpickle

from linkrank.llm.oracle import oracle_sql
from linkrank.llm.queries import queries

# Python workers get these functions with the job and need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["oracle_sql", "queries"]
