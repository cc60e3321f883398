"""Streams over landed data, each run until what has landed is used up.

State is bounded by a watermark. Sinks write one folder per micro-batch and overwrite it on a
retry, so a restarted query leaves each batch's rows once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from joblattice.constants import DEFAULT_SOURCE
from joblattice.operators import validate
from joblattice.operators.clean import clean_rows
from joblattice.operators.rows import first_per_key
from joblattice.operators.tables import UPSERT_UPDATE_COLUMNS, as_job_rows, upsert
from joblattice.schemas import API_PAGE
from joblattice.sources.pages import explode_hits, to_raw_rows

EPOCH = "epoch"


def read_page_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(API_PAGE).option("maxFilesPerTrigger", files_per_batch).json(path)


def read_parquet_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def raw_job_stream(pages: DataFrame, source: str = DEFAULT_SOURCE, locations: Sequence[str] = ()) -> DataFrame:
    """Raw listing rows of the pages as they land."""
    return to_raw_rows(explode_hits(pages), source, locations)


def clean_job_stream(raw: DataFrame, as_of: Column, fields: validate.Fields = validate.Fields()) -> DataFrame:
    """Valid raw rows of a stream, cleaned; ``_seq`` stays, to order the rows when they are applied."""
    kept = validate.valid_rows(validate.with_failed_rules(raw, fields))
    return clean_rows(kept, as_of, extra=("_seq",))


def dedup_stream(df: DataFrame, keys: Sequence[str], ts: str, delay: str = "1 day") -> DataFrame:
    """One row per key among rows at most ``delay`` apart; later repeats are left to the upsert."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def daily_count_stream(df: DataFrame, ts: str, by: Sequence[str], delay: str = "1 day") -> DataFrame:
    """Rows per day and ``by``; rows later than ``delay`` are dropped."""
    counted = df.withWatermark(ts, delay).groupBy(F.window(ts, "1 day"), *by).agg(F.count(F.lit(1)).alias("rows"))
    return counted.select(F.to_date("window.start").alias("day"), *by, "rows")


def drain(df: DataFrame, out: str, checkpoint: str, output_mode: str = "append") -> None:
    """Run a stream over everything landed and write each micro-batch to ``out/epoch=N``."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/{EPOCH}={number}")

    query = (
        df.writeStream.outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )
    query.awaitTermination()


def read_drained(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    """What ``drain`` has written, with the micro-batch number in ``epoch``."""
    with_epoch = T.StructType([*schema.fields, T.StructField(EPOCH, T.LongType())])
    return spark.read.schema(with_epoch).parquet(out)


def latest_update(updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last row per key of a stream drained in update mode."""
    return first_per_key(updates, keys, [F.desc(EPOCH)]).drop(EPOCH)


def current_table(
    base: DataFrame,
    changes: DataFrame,
    key: str = "job_id",
    order: str = "_seq",
    update_columns: Sequence[str] = (*UPSERT_UPDATE_COLUMNS, "updated_at"),
    now: Column | None = None,
) -> DataFrame:
    """The base table with all drained changes applied by micro-batch, then ``order``; commit it to compact.

    For a jobs table, changes that are clean listings get the values an insert gives, as of ``now``.
    """
    ordered = changes.withColumn(order, F.struct(F.col(EPOCH), F.col(order))).drop(EPOCH)
    if "data_quality_score" in base.columns and "data_quality_score" not in changes.columns:
        ordered = as_job_rows(ordered, F.current_timestamp() if now is None else now)
    return upsert(base, ordered, key, order, update_columns)
