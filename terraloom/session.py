"""Session settings and reliable lineage cuts."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read_options() -> dict[str, str]:
    """Per-read Parquet options: legacy dates are taken as written, never shifted."""
    return {"datetimeRebaseMode": "CORRECTED", "int96RebaseMode": "CORRECTED"}


def build_session(master: str | None = None, app: str = "terraloom", **conf: str) -> SparkSession:
    """Session with adaptive execution and UTC; the cluster's own settings win over ours."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Directory for checkpoints: the session's ``spark.checkpoint.dir`` where it is set.

    A machine-local folder is used only in local mode, where driver and tasks share it.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = context.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="terraloom-checkpoint-")
    context.setCheckpointDir(configured)
    return configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the checkpoint folder, so that a lost executor costs no replay."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the checkpoint folder for a table written by this run."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within it a query's shuffle files go when it ends, instead of when the driver happens to collect garbage."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def materialise(df: DataFrame, name: str, partition_by: Sequence[str] = (), compression: str | None = None) -> DataFrame:
    """Write a table to the checkpoint folder and read it back, with pruning of its partitions; what was shuffled for it is removed."""
    path = shared_path(df.sparkSession, name)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    with shuffles_removed(df.sparkSession):
        (writer.option("compression", compression) if compression else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def remove_table(df: DataFrame) -> None:
    """Delete a table that :func:`materialise` wrote, once nothing reads it any more; other files stay."""
    spark = df.sparkSession
    home = ensure_checkpoint_dir(spark).rstrip("/")
    folders = {re.split(r"/[^/=]+=[^/]*(?=/|$)", f.rsplit("/", 1)[0])[0] for f in df.inputFiles()}  # without those of partitions
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        where = path.toUri().getPath()
        if f"{spark._jvm.org.apache.hadoop.fs.Path(home).toUri().getPath()}/" in where:
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
