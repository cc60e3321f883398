"""Lloyd's clustering with the dimensions dealt to shards.

Every vector is cut into column blocks. A block and the matching slice of the centroids are enough for
its exact share of the squared distances; the shares of a vector are added by key, and the smallest
total names its cluster. Each column block then sums its own components by cluster and so yields the
next slice of every centroid, without ever meeting the other columns. Blocks are dealt to tasks by
vector once and kept; a round shuffles the shares of the distances and nothing else. What reaches the
driver is one integer for each centroid and dimension.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from joblattice.llm.shared import forgotten_shuffles, staged

#: Vectors with a larger component take no part: their squared distances exceed 38 digits.
LARGEST = float(1 << 40)
#: Up to this size of the whole components, distances fit 64 bits for dimensions up to 256.
NARROW = 1 << 26


def seeded(prefix: str) -> Callable[[Column], Column]:
    """Order of first centroids: sha256 of the prefix and the id as text, a null id as empty text."""
    return lambda key: F.sha2(F.concat(F.lit(prefix), F.coalesce(key.cast("string"), F.lit(""))), 256)


def column_blocks(rows: DataFrame, width: int, block: int) -> DataFrame:
    """(uid, id, b, x): the components of each vector in blocks of ``block`` neighbours."""
    starts = F.array(*[F.lit(i) for i in range(0, width, block)])
    cut = F.transform(starts, lambda s: F.slice("v", s + 1, F.lit(block)))
    return rows.select("uid", "id", F.posexplode(cut).alias("b", "x"))


def _matrix(column: pa.ListArray, wide: bool) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    return flat.astype(object) if wide else flat


def _numbers(values: np.ndarray, wide: bool) -> pa.Array:
    return pa.array([str(v) for v in values.ravel()], pa.string()) if wide else pa.array(values.ravel(), pa.int64())


def _by_block(batch: pa.RecordBatch, wide: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(block, rows, components) of a batch whose columns b and x are named so."""
    numbers = batch.column("b").to_numpy()
    for b in np.unique(numbers):
        rows = np.flatnonzero(numbers == b)
        yield int(b), rows, _matrix(batch.column("x").take(pa.array(rows)), wide)


def _assigned(held: DataFrame, centroids: np.ndarray, block: int, wide: bool) -> DataFrame:
    """(uid, id, cluster, distance): shares of all blocks added, the smaller number on ties."""
    k, kind = len(centroids), "string" if wide else "bigint"

    def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.empty((batch.num_rows, k), object if wide else np.int64)
            for b, rows, x in _by_block(batch, wide):
                part = centroids[:, b * block : (b + 1) * block]
                for c in range(k):
                    gap = x - part[c]
                    out[rows, c] = (gap * gap).sum(axis=1)
            columns = [_numbers(out[:, c], wide) for c in range(k)]
            yield pa.RecordBatch.from_arrays([batch.column("uid"), batch.column("id"), *columns], names)

    names = ["uid", "id", *(f"d{c}" for c in range(k))]
    id_kind = held.schema["id"].dataType.simpleString()
    parts = held.mapInArrow(shares, f"uid bigint, id {id_kind}, " + ", ".join(f"d{c} {kind}" for c in range(k)))
    total = [F.sum(F.col(f"d{c}").cast("decimal(38,0)") if wide else F.col(f"d{c}")).alias(f"d{c}") for c in range(k)]
    summed = parts.groupBy("uid").agg(F.first("id").alias("id"), *total)
    near = F.array_min(F.array(*[F.col(f"d{c}") for c in range(k)]))
    cluster = F.array_position(F.array(*[F.col(f"d{c}") for c in range(k)]), F.col("distance")).cast("int") - 1
    return summed.withColumn("distance", near).select("uid", "id", cluster.alias("cluster"), "distance")


def _slice_sums(placed: DataFrame, block: int, wide: bool) -> DataFrame:
    """(cluster, dim, n, total): each column block adds up its own components."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], tuple[int, np.ndarray]] = {}
        for batch in batches:
            clusters = batch.column("cluster").to_numpy()
            for b, rows, x in _by_block(batch, wide):
                for c in np.unique(clusters[rows]):
                    mine = x[clusters[rows] == c]
                    n, total = sums.get((int(c), b), (0, 0))
                    sums[int(c), b] = n + len(mine), total + mine.sum(axis=0)
        rows = [(c, b * block + i, n, str(t)) for (c, b), (n, total) in sums.items() for i, t in enumerate(total)]
        columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.int64(), pa.string()))]
        yield pa.RecordBatch.from_arrays(columns, ["cluster", "dim", "n", "total"])

    found = placed.select("cluster", "b", "x").mapInArrow(run, "cluster int, dim int, n bigint, total string")
    return found.groupBy("cluster", "dim").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))


def cluster(
    vectors: DataFrame,
    k: int = 8,
    rounds: int = 10,
    width: int = 64,
    scale: int = 1024,
    block: int = 16,
    order: Callable[[Column], Column] = seeded("3:"),
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """id, cluster, distance, cluster_inertia, inertia, centroid_sha256 after ``rounds`` rounds.

    Whole components floor(scale * x) are clustered. The first centroids are the ``k`` vectors that come
    first in ``order`` (on ties by their components), all of them when there are fewer. A round assigns
    every vector to the nearest centroid, the smaller number on ties, and replaces each centroid that has
    vectors by the floor of their mean; at the end vectors are assigned once more. All sums are exact.

    Vectors that are null, not of ``width`` components, hold a null or non-finite component or one of
    2^40 and more take no part. Repeated rows and null ids count as vectors of their own; sums that 64
    bits cannot hold come out null. An empty table gives no rows; other columns are not looked at.
    """
    spark = vectors.sparkSession
    v = F.col(vector_col).cast("array<double>").alias("v")
    rows = vectors.select(F.col(id_col).alias("id"), v).where(F.col("v").isNotNull() & (F.size("v") == width))
    rows = rows.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LARGEST)))
    whole = F.transform("v", lambda x: F.floor(x * float(scale)).cast("bigint"))
    base = staged(rows.select(F.monotonically_increasing_id().alias("uid"), "id", whole.alias("v")), "lloyd-vectors")
    first = base.orderBy(order(F.col("id")), "v").limit(k).select("v").collect()
    schema = _result_schema(id_col, vectors.schema[id_col].dataType)
    if not first:
        return spark.createDataFrame([], schema)
    widest = base.agg(F.max(F.greatest(F.array_max("v"), -F.array_min("v")))).first()[0]
    wide = widest >= NARROW
    centroids = np.array([list(r["v"]) for r in first], dtype=object if wide else np.int64)
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    held = column_blocks(base, width, block).repartition(n_parts, "uid").persist()
    with forgotten_shuffles(spark):
        for _ in range(rounds):
            placed = held.drop("id").join(_assigned(held, centroids, block, wide).select("uid", "cluster"), "uid")
            for r in _slice_sums(placed, block, wide).collect():  # k * width rows
                centroids[r["cluster"], r["dim"]] = int(r["total"]) // r["n"]
        last = staged(_assigned(held, centroids, block, wide), "lloyd-assigned")
    held.unpersist()
    return _described(last, centroids, id_col, schema)


def _described(last: DataFrame, centroids: np.ndarray, id_col: str, schema: T.StructType) -> DataFrame:
    """Adds what is known of each cluster and of all; one row a centroid travels."""
    spark = last.sparkSession
    sums = last.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    total = sum(int(r["s"]) for r in sums)

    def fits(n: int) -> int | None:
        return n if n < 1 << 63 else None

    facts = [
        (r["cluster"], fits(int(r["s"])), hashlib.sha256(",".join(map(str, centroids[r["cluster"]])).encode()).hexdigest())
        for r in sums
    ]
    known = spark.createDataFrame(facts, "cluster int, cluster_inertia bigint, centroid_sha256 string")
    inertia = F.lit(fits(total)).cast("bigint").alias("inertia")
    distance = F.expr("try_cast(distance AS bigint)").alias("distance")
    out = last.join(F.broadcast(known), "cluster")
    out = out.select(F.col("id").alias(id_col), "cluster", distance, "cluster_inertia", inertia, "centroid_sha256")
    return out.select([F.col(f"`{f.name}`") for f in schema.fields])


def _result_schema(id_col: str, id_type: T.DataType) -> T.StructType:
    return (
        T.StructType()
        .add(id_col, id_type)
        .add("cluster", T.IntegerType())
        .add("distance", T.LongType())
        .add("cluster_inertia", T.LongType())
        .add("inertia", T.LongType())
        .add("centroid_sha256", T.StringType())
    )
