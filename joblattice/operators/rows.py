"""Schema alignment, first/last row per key, append with de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from joblattice.session import broadcast_if_small, cut_lineage, is_small

# Up to this many rows per key the plan cuts each map task's rows before the shuffle by itself
# (spark.sql.optimizer.windowGroupLimitThreshold); above it we cut in two steps.
_SELF_LIMITING = 1000
_SPREAD = 64


def align_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema`` in its order: missing ones null, others dropped."""
    return df.select(
        [
            (F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of every key by ``order``; null keys form one group.

    Every map task keeps at most ``n`` rows per key before the shuffle, so a key with a third of
    all rows sends ``n`` rows per task and no more.
    """
    rank = "__rank"
    if n > _SELF_LIMITING:
        spread = Window.partitionBy(*keys, F.pmod(F.xxhash64(*df.columns), F.lit(_SPREAD))).orderBy(*order)
        df = df.withColumn(rank, F.row_number().over(spread)).filter(F.col(rank) <= n).drop(rank)
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n).drop(rank)


def keep_first(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    return first_per_key(df, keys, [F.col(order).asc()])


def repeated_sums(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(sum)``, written down: the checksums that occur on several rows. Rows of one key are among them, null being a key."""
    sums = df.select(F.xxhash64(*keys).alias("sum")).groupBy("sum").agg(F.count(F.lit(1)).alias("n"))
    return cut_lineage(sums.filter(F.col("n") > 1).select("sum"))


def has_repeats(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether a key occurs twice, null counting as a key; the keys are read, checksums of them are shuffled.

    Keys are compared themselves only where two checksums are equal.
    """
    met = repeated_sums(df, keys)
    if met.isEmpty():
        return False
    some = df.select(*keys, F.xxhash64(*keys).alias("sum")).join(broadcast_if_small(met), "sum", "left_semi")
    return not some.groupBy(*keys).count().filter("count > 1").isEmpty()


def keep_last(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    return first_per_key(df, keys, [F.col(order).desc()])


def same_key(a: DataFrame, b: DataFrame, key: str) -> Column:
    return a[key].eqNullSafe(b[key])


def shared_keys(rows: DataFrame, held: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``held``, at least all those that ``rows`` has too; null counts as a key.

    Few rows are broadcast to find their keys in ``held``, which then is only read. Otherwise all its
    distinct keys are given.
    """
    if not is_small(rows.select(key)):
        return held.select(key).distinct()
    wanted = F.broadcast(rows.select(F.col(key).alias("__wanted")).distinct())
    return held.select(key).join(wanted, held[key].eqNullSafe(wanted["__wanted"]), "left_semi").distinct()


def not_in(rows: DataFrame, held: DataFrame, key: str) -> DataFrame:
    """``rows`` whose key ``held`` does not have."""
    found = shared_keys(rows, held, key)
    return rows.join(found, same_key(rows, found, key), "left_anti")


def only_in(rows: DataFrame, held: DataFrame, key: str) -> DataFrame:
    """``rows`` whose key ``held`` has."""
    found = shared_keys(rows, held, key)
    return rows.join(found, same_key(rows, found, key), "left_semi")


def new_rows(existing: DataFrame, new: DataFrame, key: str = "job_id", order: str = "_seq") -> DataFrame:
    """First copy of every key in ``new`` that ``existing`` does not hold; only keys of it are read."""
    return not_in(keep_first(new, [key], order), existing, key)


def append_dedup(
    existing: DataFrame,
    new: DataFrame,
    key: str = "job_id",
    order: str = "_seq",
    existing_unique: bool = False,
) -> DataFrame:
    """Old and new rows together, one per key; old rows win, then the smaller ``order``.

    With ``existing_unique`` the payload of the old rows is not shuffled.
    """
    fresh = new_rows(existing, new, key, order)
    kept = existing if existing_unique else keep_first(existing, [key], order)
    return kept.unionByName(fresh, allowMissingColumns=True)


def append_stats(existing: DataFrame, new: DataFrame, key: str = "job_id") -> DataFrame:
    """One row: ``duplicates_removed``, ``new_entries``, ``total`` of an append."""
    both = existing.select(key, F.lit(1).alias("old")).unionByName(new.select(key, F.lit(0).alias("old")))
    per_key = both.groupBy(key).agg(F.count(F.lit(1)).alias("rows"), F.sum("old").alias("old"))
    counted = per_key.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("before"),
        F.coalesce(F.sum("old"), F.lit(0)).alias("old"),
        F.count(F.lit(1)).alias("total"),
    )
    return counted.select(
        (F.col("before") - F.col("total")).alias("duplicates_removed"),
        (F.col("total") - F.col("old")).alias("new_entries"),
        "total",
    )


def or_sample(df: DataFrame, sample: DataFrame) -> DataFrame:
    """``sample`` when ``df`` has no rows."""
    return sample if df.isEmpty() else df
