"""Session set-up, the shared folder, and the one size check every broadcast goes through."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_MAX_ROWS = 200_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def get_session(app: str = "joblattice", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on; on a cluster, pass no master."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it in ``spark.checkpoint.dir``.

    Only a local session may run without it; it then gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    own = os.environ.get("JOBLATTICE_LOCAL_DIR") or tempfile.mkdtemp(prefix="joblattice-")
    os.environ["JOBLATTICE_LOCAL_DIR"] = own
    return own


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder, never reused between calls."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows to the reliable checkpoint folder and go on from there."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write the rows to the shared folder as Parquet and go on from the files."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt over all cores when their files give fewer tasks than that; else as they are.

    For costly work per row on tables of few huge row groups. Tables of many files are not moved.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def is_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """Whether the rows and the bytes of their variable-length values stay within both bounds.

    The row check reads partitions only until it has seen enough; the bytes are summed only for a
    frame that has passed it. Both run the frame, so give one that is cheap or written down.
    """
    if df.select(F.lit(1)).offset(max_rows).limit(1).collect():
        return False
    sizes = [_byte_size(f) for f in df.schema.fields if not isinstance(f.dataType, _FIXED)]
    if not sizes:
        return True
    total = df.agg(F.sum(sum(sizes[1:], sizes[0]))).first()[0]
    return total is None or total <= max_bytes


_FIXED = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _byte_size(field: T.StructField) -> Column:
    value = F.col(f"`{field.name}`")
    if not isinstance(field.dataType, (T.StringType, T.BinaryType)):
        value = F.to_json(F.struct(value))
    return F.coalesce(F.octet_length(value), F.lit(0)).cast("bigint")


def broadcast_if_small(
    df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES
) -> DataFrame:
    """Hint a broadcast for a frame within the bounds; leave any other to a shuffle join."""
    return F.broadcast(df) if is_small(df, max_rows, max_bytes) else df
