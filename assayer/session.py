"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "assayer", **settings: str) -> SparkSession:
    """A session with the adaptive settings the operators count on.

    Sizes that belong to the cluster (memory, shuffle partitions, master)
    are left to the caller.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_LOCAL_FOLDERS: dict[str, str] = {}
_MADE: dict[str, list[str]] = {}
_NAMING = threading.Lock()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a session on one machine may name none: it gets a local temporary
    folder, one per application. Elsewhere that folder would be another one
    on every executor, and what is read back would be incomplete.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    application = spark.sparkContext.applicationId
    with _NAMING:
        if application not in _LOCAL_FOLDERS:
            _LOCAL_FOLDERS[application] = tempfile.mkdtemp(prefix="assayer-")
        return _LOCAL_FOLDERS[application]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _MADE.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Remove the tables that this application has put into the shared folder; returns how many. Findings that are still
    lazy must not be read afterwards."""
    jvm, removed = spark.sparkContext._jvm, 0
    for name in _MADE.pop(spark.sparkContext.applicationId, []):
        path = jvm.org.apache.hadoop.fs.Path(name)
        removed += path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return removed


def pinned(df: DataFrame) -> DataFrame:
    """The same rows, computed once and kept as a table in the shared folder.

    For findings that several later steps read, and for sources that are
    costly to parse. The table survives the loss of executors, and its size
    is known to the planner.
    """
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    path = scratch_path(df.sparkSession, "table")
    plain.write.parquet(path)
    return df.sparkSession.read.schema(plain.schema).parquet(path).toDF(*df.columns)


def bucketed(df: DataFrame, column: str, count: int) -> DataFrame:
    """``pinned``, dealt into buckets by a column: joins by it leave these rows where they are. The catalog has the table only
    until it is written."""
    path, name = scratch_path(df.sparkSession, "table"), f"assayer_{uuid.uuid4().hex}"
    df.repartition(count, column).write.format("parquet").bucketBy(count, column).option("path", path).saveAsTable(name)
    found = df.sparkSession.table(name)
    df.sparkSession.sql(f"DROP TABLE {name}")
    return found


def removed(*tables: DataFrame | None) -> None:
    """Deletes what ``pinned`` or ``bucketed`` has stored for these tables, which nothing may read afterwards."""
    for table in tables:
        for name in {m[1] for f in (table.inputFiles() if table is not None else []) if (m := re.search(r"/(table-[0-9a-f]{32})/", f))}:
            context = table.sparkSession.sparkContext
            for path in [p for p in _MADE.get(context.applicationId, []) if p.endswith(f"/{name}")]:
                at = context._jvm.org.apache.hadoop.fs.Path(path)
                at.getFileSystem(context._jsc.hadoopConfiguration()).delete(at, True)
                _MADE[context.applicationId].remove(path)


@contextmanager
def lean(spark: SparkSession) -> Iterator[None]:
    """Within, shuffle files go as soon as the query that wrote them has ended, and Python gets fewer rows at once."""
    rows = min(1000, int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")))
    settings = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxRecordsPerBatch": str(rows)}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def together(spark: SparkSession, *steps: Callable, at_once: int = 8) -> list:
    """What the steps return, in their order. None needs another, so the jobs of one fill the cores that another leaves idle.

    The first error in the order of the steps is raised once all have ended.
    """
    with ThreadPoolExecutor(max(1, min(at_once, len(steps)))) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [r.result() for r in running]
