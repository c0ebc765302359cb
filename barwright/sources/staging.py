"""Writing an intermediate result once so that later reads do not recompute it."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


_open_scope: ContextVar[list[str] | None] = ContextVar("open_scope", default=None)
_left: dict[str, list[str]] = {}  # staged outside a scope, by application; removed when the program ends


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a temporary one only on a local master without it."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="barwright-"))
    return spark.sparkContext.getCheckpointDir()


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Unlike a cached frame it survives lost executors, and unlike an RDD checkpoint the reader still
    prunes columns and pushes filters. Spark also knows the size of what was written before it plans
    the next query: a small side of a join is broadcast at once, if it is below the session's threshold,
    instead of after the large side has been shuffled.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    scope = _open_scope.get()
    if scope is None:
        scope = _left.setdefault(spark.sparkContext.applicationId, [])
        if len(_left) == 1 and not scope:
            atexit.register(_remove_left)
    scope.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove what is staged inside the block when it ends; frames over it must be used up by then."""
    paths: list[str] = []
    token = _open_scope.set(paths)
    try:
        yield
    finally:
        _open_scope.reset(token)
        _remove(spark, paths)


def _remove(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def _remove_left() -> None:
    """What this application staged for frames that it handed out; nobody reads those after its end."""
    spark = SparkSession.getActiveSession()
    if spark is not None:
        with contextlib.suppress(Exception):  # the cluster may be gone already
            _remove(spark, _left.get(spark.sparkContext.applicationId, []))
