"""Session settings the library relies on, and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from threading import Lock
from weakref import WeakKeyDictionary

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Results depend on the first setting: timestamps without an offset are read as UTC. The last one lets a task keep the files
# of two partitions open (of histories: closed and current rows) instead of sorting whole rows before it writes; with more
# partitions Spark sorts the rest.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.maxConcurrentOutputFileWriters": "2",
}

DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def pin(spark: SparkSession) -> SparkSession:
    """Apply SETTINGS to a session that somebody else created."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("recordloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
    )
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shuffle_partitions_for(input_bytes: int, target_bytes: int = 128 << 20, least: int = 200) -> int:
    """Number of shuffle partitions that keeps each near `target_bytes`; AQE merges the small ones."""
    return max(least, -(-input_bytes // target_bytes))


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it in spark.checkpoint.dir.

    Only a master without executors of its own may fall back to a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="recordloom-"))
    return context.getCheckpointDir()


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path under the shared folder that no earlier run used."""
    return os.path.join(shared_dir(spark), f"{purpose}-{uuid.uuid4().hex}")


_writing: WeakKeyDictionary[SparkSession, tuple[int, str]] = WeakKeyDictionary()  # jobs now, and the setting outside them
_writing_lock = Lock()


@contextmanager
def written_once(spark: SparkSession) -> Iterator[None]:
    """Jobs begun inside remove their shuffle files when they end, so that the next one has the disk.

    For writes, whose plan is never run again. Outside, files stay as the session has it.
    """

    def count(by: int) -> None:
        with _writing_lock:
            jobs, outside = _writing.get(spark) or (0, spark.conf.get(DROP_SHUFFLES))
            jobs += by
            spark.conf.set(DROP_SHUFFLES, "true" if jobs else outside)
            if jobs:
                _writing[spark] = jobs, outside
            else:
                del _writing[spark]

    count(1)
    try:
        yield
    finally:
        count(-1)


def stored(df: DataFrame) -> DataFrame:
    """`df` written to a table in the shared folder and read from there.

    Cuts the lineage: what reads it is not affected by lost executors, sees the same rows in the same
    order each time, and has their size.
    """
    path = new_folder(df.sparkSession, "stage")
    with written_once(df.sparkSession):
        df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def side_by_side(spark: SparkSession, steps: Iterable[Callable[[], object]]) -> list:
    """Results of steps that do not need each other, in order.

    Their jobs share the executors: the tasks of one fill the cores that another leaves idle at the end of its stages.
    """
    steps = [inheritable_thread_target(spark)(step) for step in steps]
    with ThreadPoolExecutor(len(steps)) as pool:
        return [done.result() for done in [pool.submit(step) for step in steps]]


def settled_keys(keys: DataFrame) -> tuple[DataFrame, int]:
    """Distinct `keys` computed once, and their number.

    Spark knows the bytes of the stored table, so a join broadcasts it below its own limit and shuffles beyond.
    """
    keys = stored(keys.distinct())
    return keys, keys.count()
