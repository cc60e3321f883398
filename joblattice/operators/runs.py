"""The log of stage runs: one row per change of state, folded to one row per batch and stage."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from joblattice.constants import STAGE_COUNTER
from joblattice.operators.rows import align_schema
from joblattice.schemas import BATCH_RUNS

COUNTERS = [f.name for f in BATCH_RUNS.fields if f.name.startswith("jobs_")]


def run_row(
    spark: SparkSession,
    batch_id: str,
    stage: str,
    status: str,
    now: Column,
    jobs_count: int = 0,
    error_message: str | None = None,
    seconds: int = 0,
    counts: Mapping[str, int] | None = None,
) -> DataFrame:
    """A row of the log; ``jobs_count`` goes to the counter of the stage, ``counts`` to named ones."""
    values = {STAGE_COUNTER.get(stage, "jobs_collected"): jobs_count, **(counts or {})}
    row = spark.range(1).select(
        F.lit(batch_id).alias("batch_id"),
        F.to_date(now).alias("batch_date"),
        F.lit(stage).alias("stage"),
        F.lit(status).alias("status"),
        *[F.lit(values.get(name, 0)).alias(name) for name in COUNTERS],
        F.lit(error_message).alias("error_message"),
        F.lit(seconds).alias("execution_time_seconds"),
        now.alias("created_at"),
        now.alias("updated_at"),
    )
    return align_schema(row, BATCH_RUNS)


def last_states(log: DataFrame) -> DataFrame:
    """The last state of every batch and stage, created when its first row was; columns as in ``log``.

    A partial aggregate, so a batch of very many rows is no single task.
    """
    body = [c for c in log.columns if c not in ("batch_id", "stage", "created_at")]
    # At equal times the final states sort after the earlier ones.
    order = F.struct("updated_at", F.col("status").isin("success", "failed").alias("final"))
    folded = log.groupBy("batch_id", "stage").agg(
        F.max_by(F.struct(*body), order).alias("last"), F.min("created_at").alias("created_at")
    )
    return folded.select("batch_id", "stage", "last.*", "created_at").select(*log.columns)


def current_runs(log: DataFrame) -> DataFrame:
    """The last states of a whole run log, in the order of its schema."""
    return last_states(log).select(*BATCH_RUNS.fieldNames())
