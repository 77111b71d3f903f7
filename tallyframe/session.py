"""Session defaults and the shared folder used for cut points."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

LIMITS = {
    # Largest table that is ever hinted as a broadcast.
    "spark.tallyframe.broadcastBytes": 64 * 1024 * 1024,
    # Largest table that is ordered inside a single task.
    "spark.tallyframe.singleTaskRows": 1_000_000,
    # Largest tree node whose rows go to one task, which grows the subtree.
    "spark.tallyframe.nodeRows": 131_072,
    # Largest table whose values are counted without a sketch.
    "spark.tallyframe.countedRows": 5_000_000,
    # Largest number of cells handed to the exact `percentile` aggregate.
    "spark.tallyframe.percentileCells": 5_000_000,
}


def build_session(app: str = "tallyframe", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution and UTC time."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def limit(spark: SparkSession, key: str) -> int:
    """A `spark.tallyframe.*` bound, read from the session."""
    name = f"spark.tallyframe.{key}"
    return int(spark.conf.get(name, str(LIMITS[name])))


def shared_folder(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`; a temporary one only in local mode."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        folder = context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="tallyframe-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


# Paths handed out within each open scope, the innermost last.
_scopes: list[list[str]] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder for a table written by a job."""
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete, at its end, the scratch tables whose paths are made within it.

    A job that writes its result elsewhere runs in one; a result that is still to
    be computed must not leave it, as its tables are gone then. Only paths that
    `scratch_path` has made up are deleted.
    """
    made: list[str] = []
    _scopes.append(made)
    try:
        yield
    finally:
        _scopes.pop()
        for path in made:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
