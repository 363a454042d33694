"""Pages of each step, counted while the step runs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


class CountedSteps:
    """Observations of the rank tables of steps that have not been reported yet.

    An observation counts rows of every task that ran, so a repeated task - after
    an executor was lost, or a speculative copy - would count twice. Each
    task's rows carry its partition, and its first row is marked: as many
    marked rows as different partitions means that no task with rows was repeated.
    Else the table is counted by a job of its own.
    """

    def __init__(self, on_step: Callable[[int, int], None]) -> None:
        self._on_step = on_step
        self._open: list[tuple[int, Observation, DataFrame]] = []

    def watch(self, step: int, ranks: DataFrame) -> DataFrame:
        """``ranks`` with an observation in its plan."""
        observation = Observation(f"step-{step}")
        first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
        marked = ranks.withColumns({"_part": F.spark_partition_id(), "_first": first})
        watched = marked.observe(
            observation,
            F.count(F.lit(1)).alias("pages"),
            F.count(F.when(F.col("_first"), 1)).alias("tasks"),
            F.collect_set("_part").alias("parts"),
        )
        self._open.append((step, observation, ranks))
        return watched.select(*ranks.columns)

    def report(self) -> None:
        """Call back for all steps that ran since the last report; the job that ran them is done."""
        for step, observation, ranks in self._open:
            seen = observation.get
            exact = seen["tasks"] == len(seen["parts"])
            self._on_step(step, seen["pages"] if exact else ranks.count())
        self._open.clear()
