"""Session helpers: the shared folder for checkpoints and scratch output."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

WIDTH_SETTING = "spark.sql.shuffle.partitions"
INITIAL_WIDTH_SETTING = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
TASK_BYTES_SETTING = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
BROADCAST_SETTING = "spark.sql.autoBroadcastJoinThreshold"
ADAPTIVE_BROADCAST_SETTING = "spark.sql.adaptive.autoBroadcastJoinThreshold"
BATCH_SETTING = "spark.sql.inMemoryColumnarStorage.batchSize"
# Plans as they are written; sorted rows are grouped as they lie, without a hash table.
IN_PLACE = {"spark.sql.adaptive.enabled": "false", "spark.sql.execution.replaceHashWithSortAgg": "true"}
_scratch: list[str] = []


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure reliable checkpoints have a home and return its path.

    The cluster names the folder in ``spark.checkpoint.dir``. Only a local-mode
    session without that setting gets a temporary folder: on a cluster such a
    folder would not be visible to the other machines, so that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="linkrank-checkpoints-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, not yet existing path inside the shared checkpoint folder.

    ``clear_scratch`` removes what was written below such paths.
    """
    folder = f"{ensure_checkpoint_dir(spark)}/scratch-{uuid.uuid4().hex}"
    _scratch.append(folder)
    return f"{folder}/{name}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove all scratch folders of this program."""
    while _scratch:
        remove(spark, _scratch.pop())


def remove(spark: SparkSession, path: str) -> None:
    """Delete what is at ``path``, if anything."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(location, True)


def discard_checkpoint(table: DataFrame) -> None:
    """Remove the files of a table that ``checkpoint()`` returned; it can't be read afterwards."""
    kept = table._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
    if kept.isDefined():
        remove(table.sparkSession, kept.get())


def collect_garbage(spark: SparkSession) -> None:
    """Let go of what finished jobs have left with the driver: plans and broadcast tables in memory, shuffles on disk.

    Spark removes them once the driver's garbage is collected, which may be long after.
    """
    gc.collect()
    spark._jvm.System.gc()


def require_absent(spark: SparkSession, path: str) -> None:
    """Raise ``FileExistsError`` if there is something at ``path``."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = location.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if files.exists(location):
        raise FileExistsError(f"output path {path} exists")


def default_width(spark: SparkSession) -> int:
    """Number of partitions Spark gives a shuffle, the default for a graph."""
    conf = spark.conf
    adaptive = conf.get("spark.sql.adaptive.enabled") == "true"
    if adaptive and conf.get("spark.sql.adaptive.coalescePartitions.enabled") == "true":
        initial = conf.get(INITIAL_WIDTH_SETTING, None)
        if initial and initial.isdigit():
            return int(initial)
    return int(conf.get(WIDTH_SETTING))


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, object]) -> Iterator[None]:
    """Session settings for jobs that run inside."""
    before = {k: spark.conf.get(k, None) for k in wanted}  # None: not set, the default holds
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def shuffle_width(spark: SparkSession, width: int):
    """Context in which shuffles have ``width`` partitions."""
    names = [WIDTH_SETTING]
    if spark.conf.get(INITIAL_WIDTH_SETTING, None):
        names.append(INITIAL_WIDTH_SETTING)
    return _settings(spark, dict.fromkeys(names, width))


def _bytes(spark: SparkSession, name: str, default: str) -> int:
    size = spark._jsparkSession.sessionState().conf().getConfString(name, default)
    if size.startswith("-"):  # off
        return -1
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size)


def smaller_tasks(spark: SparkSession, most: int):
    """Context in which adaptive execution aims at ``most`` shuffled bytes a task, if the session aims at more."""
    return _settings(spark, {TASK_BYTES_SETTING: min(_bytes(spark, TASK_BYTES_SETTING, "64m"), most)})


def smaller_broadcasts(spark: SparkSession, most: int):
    """Context in which tables of more than ``most`` bytes are not broadcast in joins unless a hint asks for it."""
    names = [BROADCAST_SETTING]
    if spark.conf.get(ADAPTIVE_BROADCAST_SETTING, None):
        names.append(ADAPTIVE_BROADCAST_SETTING)
    return _settings(spark, {name: min(_bytes(spark, name, "10m"), most) for name in names})


def checkpoint_in_place(table: DataFrame) -> DataFrame:
    """``table.checkpoint()`` that keeps the partitioning and order of the plan.

    Adaptive execution may change both while a job runs, so its checkpoints
    count as laid out in no way. The setting is read when the job starts.
    """
    with _settings(table.sparkSession, IN_PLACE):
        return table.checkpoint()


def keep_in_place(table: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK_DESER) -> DataFrame:
    """``table.persist()`` that keeps the partitioning and order of the plan."""
    with _settings(table.sparkSession, IN_PLACE):
        return table.persist(level)


def small_batches(spark: SparkSession, rows: int):
    """Context in which tables are stored in batches of ``rows`` rows, from ``persist()`` to the first job on them."""
    return _settings(spark, {BATCH_SETTING: rows})


def fit_width(table: DataFrame, wanted: int | None = None) -> int:
    """Set the shuffle width of the session for work on ``table``; returns it.

    It becomes ``wanted``, or else what the submitter configured, or else one
    partition per input split but no fewer than the cores there are. For
    programs that own their session.
    """
    spark = table.sparkSession
    sc = spark.sparkContext
    if not wanted and not sc.getConf().contains(WIDTH_SETTING):
        splits = table.rdd.getNumPartitions()
        wanted = max(splits, sc.defaultParallelism)
    if wanted:
        spark.conf.set(WIDTH_SETTING, wanted)
    return default_width(spark)
