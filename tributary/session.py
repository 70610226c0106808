"""Session settings, lineage cuts and hand-off tables."""

from __future__ import annotations

import math
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from pathlib import Path

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

#: Rows that one partition of a loop's table, or one block of a hot key, should hold.
BLOCK_ROWS = 500_000
#: Partitions a core that smaller blocks may lead to.
WAVES = 16

_open: list[list[str]] = []


def build_session(app: str = "tributary", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job here relies on; `conf` overrides them.

    On a cluster leave `master` out and let spark-submit name it together with
    `spark.checkpoint.dir`, the shared folder used by `cut` and `handoff`.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def share_code(spark: SparkSession) -> None:
    """Let Python workers import this package wherever the driver was started.

    Functions that run in workers are shipped by name. On a cluster without this path
    the package comes by `--py-files` or is installed, and the entry does no harm.
    """
    root = str(Path(__file__).resolve().parent.parent)
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for tables and lineage cuts, read from the session.

    Only a local master may run without `spark.checkpoint.dir`; it then gets a
    fresh temporary folder. Executors on other machines could not read one. What
    the cluster names is taken as it is: a `file:` folder may be a shared mount.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    current = context._jsc.sc().getCheckpointDir()
    if not current.isDefined():
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tributary-checkpoint-"))
        current = context._jsc.sc().getCheckpointDir()
    return current.get()


def handoff(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write `df` as a Parquet table in the shared folder and read it back.

    Stages pass tables on this way: readers prune columns, Catalyst plans with
    true sizes, and nothing upstream runs again when an executor is lost. With `keep`
    the table outlives the workspace it is written in.
    """
    spark = df.sparkSession
    root = checkpoint_root(spark)
    path = f"{root}/tables-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    if _open and not keep:
        _open[-1].append(path)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.written_at = path
    return table


@contextmanager
def workspace(spark: SparkSession) -> Iterator[None]:
    """Delete all hand-off tables made inside when the block ends, however it ends.

    For a job that writes its results itself: frames that still read a table made
    inside must not be used afterwards.
    """
    _open.append([])
    try:
        yield
    finally:
        for path in _open.pop():
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def discard(*tables: DataFrame) -> None:
    """Delete hand-off tables that nothing will read again; other frames are left alone."""
    for table in tables:
        path = getattr(table, "written_at", None)
        if path:
            _delete(table.sparkSession, path)


def cut(df: DataFrame) -> DataFrame:
    """Materialize `df` and drop its lineage, for loops and for rows that must be read twice.

    A written table rather than checkpoint(): a checkpoint keeps the size
    estimate of its plan, which multiplies with every join of a loop.
    """
    return handoff(df, "step")


def side_by_side(spark: SparkSession, *parts: Callable) -> list:
    """What the parts return that do not need each other; each submits its Spark jobs in a thread of its own, under the job group of this one."""
    with ThreadPoolExecutor(len(parts)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(part)) for part in parts]]


def block_rows(spark: SparkSession) -> int:
    """BLOCK_ROWS, or what the session sets in `spark.tributary.blockRows`."""
    return int(spark.conf.get("spark.tributary.blockRows", str(BLOCK_ROWS)))


def layout_width(spark: SparkSession, rows: int) -> int:
    """Partitions for a table that a loop reads again and again: grows with its rows.

    A session's smaller blocks give more partitions up to WAVES tasks a core, as every step of the loop runs a task for each;
    beyond that a partition takes several blocks, and BLOCK_ROWS at most.
    """
    cores = spark.sparkContext.defaultParallelism
    return max(cores, min(math.ceil(rows / block_rows(spark)), WAVES * cores), math.ceil(rows / BLOCK_ROWS))
