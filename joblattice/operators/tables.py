"""Table maintenance: upsert, archive, rollback, monthly partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from joblattice.constants import DEFAULT_SOURCE, UPSERT_UPDATE_COLUMNS
from joblattice.functions.values import default_quality_score
from joblattice.operators.rows import align_schema, has_repeats, not_in
from joblattice.schemas import JOBS
from joblattice.session import broadcast_if_small, cut_lineage, is_small


def as_job_rows(clean: DataFrame, now: Column) -> DataFrame:
    """Clean listings in the layout of the jobs table, with the values an insert gives.

    A ``_seq`` column is kept for ``upsert`` to order by; the days since posting are never stored.
    """
    source = F.col("source") if "source" in clean.columns else F.lit(DEFAULT_SOURCE)
    valued = clean.withColumns(
        {
            "source": source,
            "data_quality_score": default_quality_score(),
            "created_at": now,
            "updated_at": now,
            "days_since_posted": F.lit(None).cast("int"),
        }
    )
    layout = [*JOBS.fields, *[f for f in valued.schema.fields if f.name == "_seq"]]
    return align_schema(valued, T.StructType(layout))


def _accepted(required: Sequence[str]) -> Column:
    ok = F.lit(True)
    for name in required:
        ok = ok & F.col(name).isNotNull()
    return ok


def fold_updates(
    updates: DataFrame,
    key: str,
    order: str | None,
    update_columns: Sequence[str],
) -> DataFrame:
    """One row per key as if the rows were applied in order: updated columns from the last row, the rest from the first.

    Partial aggregation folds the copies of a hot key inside each map task.
    """
    if order is None:
        return updates
    columns = [c for c in updates.columns if c not in (key, order)]
    last = [c for c in columns if c in update_columns]
    first = [c for c in columns if c not in update_columns]
    folds = []
    if last:
        folds.append(F.max_by(F.struct(*last), F.col(order)).alias("__last"))
    if first:
        folds.append(F.min_by(F.struct(*first), F.col(order)).alias("__first"))
    folded = updates.groupBy(key).agg(*folds)
    pick = [F.col(f"__last.{c}" if c in last else f"__first.{c}").alias(c) for c in columns]
    return folded.select(key, *pick)


def upsert(
    target: DataFrame,
    updates: DataFrame,
    key: str = "job_id",
    order: str | None = None,
    update_columns: Sequence[str] = (*UPSERT_UPDATE_COLUMNS, "updated_at"),
    required: Sequence[str] | None = None,
) -> DataFrame:
    """``target`` with the rows of ``updates`` applied; keys of the target are unique.

    On a match only ``update_columns`` change. Without ``order`` a key may occur once in the batch; a
    second row of it is an error. A batch that passes the size check is broadcast and
    the target is neither shuffled nor sorted; a larger one is joined on the key. Write the result
    to a new place, never over the target it reads.
    """
    batch = fold_updates(updates.filter(_accepted(required or (key,))), key, order, update_columns)
    columns = target.columns
    batch = cut_lineage(batch)
    if order is None and has_repeats(batch, [key]):
        raise ValueError(f"rows of one {key} need an order to be applied in")
    joined = _upsert_small if is_small(batch) else _upsert_large
    merged = joined(target, batch, key, columns, update_columns)
    return merged.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.schema.fields])


def _prefixed(batch: DataFrame) -> DataFrame:
    return batch.select(*[F.col(c).alias(f"__u_{c}") for c in batch.columns])


def _upsert_small(target, batch, key, columns, update_columns) -> DataFrame:
    u = _prefixed(batch)
    matched = F.col(f"__u_{key}").isNotNull()
    merged = target.join(F.broadcast(u), target[key] == u[f"__u_{key}"], "left").select(
        *[
            (F.when(matched, F.col(f"__u_{c}")).otherwise(F.col(c)) if c in update_columns and c in batch.columns else F.col(c)).alias(c)
            for c in columns
        ]
    )
    held = target.select(key).join(F.broadcast(batch.select(key)), key, "left_semi")
    fresh = batch.join(held, key, "left_anti")
    return merged.unionByName(align_schema(fresh, target.schema))


def _upsert_large(target, batch, key, columns, update_columns) -> DataFrame:
    u = _prefixed(batch)
    old, new = target[key].isNotNull(), F.col(f"__u_{key}").isNotNull()
    joined = target.join(u, target[key] == u[f"__u_{key}"], "full_outer")
    picks = []
    for c in columns:
        if c == key:
            picks.append(F.coalesce(target[key], F.col(f"__u_{key}")).alias(c))
        elif c not in batch.columns:
            picks.append(target[c].alias(c))
        elif c in update_columns:
            picks.append(F.when(new, F.col(f"__u_{c}")).otherwise(target[c]).alias(c))
        else:
            picks.append(F.when(old, target[c]).otherwise(F.col(f"__u_{c}")).alias(c))
    return joined.select(*picks)


def upsert_counts(
    target: DataFrame,
    updates: DataFrame,
    key: str = "job_id",
    required: Sequence[str] | None = None,
) -> DataFrame:
    """One row ``inserted, updated, failed``: a second copy of a new key counts as an update."""
    accepted = _accepted(required or (key,))
    failed = updates.agg(F.count_if(~accepted).alias("failed"), F.count(F.lit(1)).alias("all"))
    keys = updates.filter(accepted).select(key).distinct()
    inserted = not_in(keys, target, key).agg(F.count(F.lit(1))).scalar()
    return failed.select(
        inserted.alias("inserted"),
        (F.col("all") - F.col("failed") - inserted).alias("updated"),
        "failed",
    )


def archive_split(jobs: DataFrame, as_of: Column, date_column: str = "posted_date", years: int = 1) -> tuple[DataFrame, DataFrame]:
    """(kept, archived): rows dated more than ``years`` before ``as_of`` are archived; undated rows stay."""
    cutoff = F.add_months(as_of, -12 * years)
    old = F.coalesce(F.col(date_column) < cutoff, F.lit(False))
    return jobs.filter(~old), jobs.filter(old)


def rollback(
    jobs: DataFrame,
    since: Column,
    backup: DataFrame | None = None,
    key: str = "job_id",
    created: str = "created_at",
) -> DataFrame:
    """Rows created before ``since``, plus the backup rows whose key is then missing."""
    kept = jobs.filter(F.coalesce(F.col(created) < since, F.lit(True)))
    if backup is None:
        return kept
    return kept.unionByName(backup.join(kept.select(key), key, "left_anti"))


def delete_keys(jobs: DataFrame, keys: DataFrame, key: str = "job_id") -> DataFrame:
    """``jobs`` without the rows of the given keys; the keys are written down before they are measured."""
    return jobs.join(broadcast_if_small(cut_lineage(keys.select(key).distinct())), key, "left_anti")


def with_month(jobs: DataFrame, date_column: str = "posted_date", month: str = "posted_month") -> DataFrame:
    """Adds the first day of the month, the partition column of the written jobs table."""
    return jobs.withColumn(month, F.trunc(F.col(date_column), "MM"))
