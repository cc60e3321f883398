"""Helpers of the training-data operators: written stages, word splitting, connected components."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from joblattice.session import cut_lineage, scratch_path

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


#: With this on, Spark deletes a query's shuffle files when the query ends; a written stage needs them no more.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def forgotten_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries run inside drop their shuffle files when they end."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write the rows to the shared folder and go on from the files."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with forgotten_shuffles(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def discard(df: DataFrame) -> None:
    """Delete the files of a stage that nothing reads any more."""
    jvm, path = df.sparkSession._jvm, df.staged_at
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)


def free_name(taken: list[str], wish: str) -> str:
    """A column name that clashes with none of the taken ones, whatever their case."""
    low = {t.lower() for t in taken}
    while wish.lower() in low:
        wish += "_"
    return wish


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; a null reads as an empty text."""
    return [b"" if v is None else v for v in column.cast(pa.binary()).to_pylist()]


def crc_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def hash_sample(rows: DataFrame, key: Column, max_rows: int) -> DataFrame:
    """At most about nine tenths of ``max_rows`` rows by a hash of their key, all rows if they are few.

    Which rows depends on keys and their number alone; no task gathers rows to choose from.
    """
    n = rows.count()
    if n <= max_rows:
        return rows
    chosen = rows.where(F.pmod(F.xxhash64(key), F.lit(1 << 40)) < int((1 << 40) * 0.9 * max_rows / n))
    return chosen.limit(max_rows)  # keys that repeat could pass the threshold together


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def never_broadcast(df: DataFrame) -> DataFrame:
    """For the side of a join that is exploded first: Spark sizes it as if every row gave one and would broadcast it whole."""
    return df.hint("merge")


def side_by_side(held: DataFrame, asked: DataFrame) -> DataFrame:
    """Rows of both frames, those of one ``block`` and ``dim`` in one task and in a row: the held ones, then the asking ones.

    ``held`` and ``asked`` have the same columns, ``block`` and ``dim`` among them; ``asks`` tells them apart. No
    block is gathered into one row or sent more than once, and nothing is broadcast.
    """
    both = held.withColumn("asks", F.lit(False)).unionByName(asked.withColumn("asks", F.lit(True)))
    return both.repartition("block", "dim").sortWithinPartitions("block", "dim", "asks")


def block_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, bool, pa.RecordBatch]]:
    """((block, dim), asks, rows) for runs of rows that agree in these; a run may go on in the next item."""
    for batch in batches:
        keys = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("block", "dim", "asks")]
        turns = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
        edges = [0, *turns.tolist(), batch.num_rows]
        for start, end in zip(edges, edges[1:]):
            if start < end:
                block, dim, asks = (k[start].item() for k in keys)
                yield (block, dim), asks, batch.slice(start, end - start)


def as_matrix(column: pa.ListArray) -> np.ndarray:
    """The rows of a column of equally long lists without nulls."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def components(edges: DataFrame) -> DataFrame:
    """(node, label) with label the smallest node that links reach, for every node that has a link.

    ``edges`` holds two bigint columns a and b. Alternating large-star and small-star steps keep the
    number of edges from growing; a hub is met by a partial minimum and a join, never gathered.
    """
    current = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    current = cut_lineage(current)
    seen = None
    while True:
        state = current.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == seen or state[0] == 0:
            return current.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
                current.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
            )
        seen = state
        both = current.union(current.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        current = cut_lineage(small.union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())


def sharded(sizes: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Consecutive ranges whose sizes add up to at most ``limit``, or that hold one larger item."""
    out, start, total = [], 0, 0
    for i, size in enumerate(sizes.tolist()):
        if total and total + size > limit:
            out.append((start, i))
            start, total = i, 0
        total += size
    if start < len(sizes):
        out.append((start, len(sizes)))
    return out
