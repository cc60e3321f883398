"""Nearest neighbours by randomly rotated one-bit codes with error bounds.

Every vector is scaled to length 1, rotated by a fixed random orthogonal matrix and kept as the signs
of its coordinates, packed into 64-bit words, with one correction scalar: the inner product of the
rotated vector with its own code. A query is rotated too and rounded to four bits a coordinate, so its
inner product with a code is a few ANDs and bit counts; divided by the scalar it estimates the cosine,
with a bound on the error that the scalar gives. Vectors whose upper bound reaches the k-th best lower
bound are reranked exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from joblattice.llm.shared import as_matrix, block_runs, side_by_side, staged

QUERY_BLOCK, VECTOR_BLOCK, QUERY_BITS, SEED = 256, 4096, 4, 20
#: Standard errors of the estimate that the bounds span.
EPSILON = 3.0


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", nonzero: bool = True) -> DataFrame:
    """(id, v): rows whose vector is not null, empty, zero or with null or non-finite components."""
    v = F.col(vector_col).cast("array<double>")
    out = vectors.select(F.col(id_col).alias("id"), v.alias("v")).where("id is not null and v is not null and size(v) > 0")
    out = out.where(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    return out.where(F.exists("v", lambda x: x != 0)) if nonzero else out


def encode(unit: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes, scalars): packed signs, 64 a word, and the inner product of each vector with its code."""
    turned = unit @ turn
    dim = unit.shape[1]
    bits = np.zeros((len(unit), -(-dim // 64) * 64), np.uint8)
    bits[:, :dim] = turned > 0
    codes = np.packbits(bits, axis=1, bitorder="little").view("<u8")
    return codes, np.abs(turned).sum(axis=1) / math.sqrt(dim)


def estimate(codes: np.ndarray, scalars: np.ndarray, queries: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(estimates, errors): of the inner product of each unit query with each unit vector."""
    dim = queries.shape[1]
    turned = queries @ turn
    low = turned.min(axis=1, keepdims=True)
    step = np.maximum((turned.max(axis=1, keepdims=True) - low) / ((1 << QUERY_BITS) - 1), 1e-12)
    level = np.rint((turned - low) / step).astype(np.uint8)
    padded = np.zeros((len(queries), codes.shape[1] * 64), np.uint8)
    padded[:, :dim] = level
    ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
    dot = np.zeros((len(queries), len(codes)), np.float64)
    for j in range(QUERY_BITS):
        plane = np.packbits((padded >> j) & 1, axis=1, bitorder="little").view("<u8")
        for w in range(codes.shape[1]):
            dot += np.bitwise_count(plane[:, w : w + 1] & codes[None, :, w]).astype(np.float64) * (1 << j)
    # sum over coordinates of the rounded query times the sign
    sums = level.sum(axis=1, keepdims=True, dtype=np.int64)
    signed = step * (2 * dot - sums) + low * (2 * ones[None, :] - dim)
    found = signed / math.sqrt(dim) / scalars[None, :]
    spread = np.sqrt(np.maximum(1 - scalars**2, 0)) / scalars / math.sqrt(max(dim - 1, 1))
    rounding = step / (2 * math.sqrt(3)) / scalars[None, :]
    return found, EPSILON * np.sqrt(spread[None, :] ** 2 + rounding**2)


def _lengths(x: np.ndarray) -> np.ndarray:
    """Vector lengths without overflow or underflow of the squares."""
    top = np.abs(x).max(axis=1, keepdims=True)
    return top[:, 0] * np.sqrt(((x / top) ** 2).sum(axis=1))


class Coded:
    """A block of vectors with its codes."""

    def __init__(self, ids: list, vectors: np.ndarray):
        self.ids, self.unit = ids, vectors / _lengths(vectors)[:, None]
        self.turn = rotation(vectors.shape[1])
        self.codes, self.scalars = encode(self.unit, self.turn)

    def search(self, q_ids: list, queries: np.ndarray, k: int) -> list[tuple]:
        """(query, vector, cosine): each query's best ``k`` of the block, the query's own row left out."""
        ids, unit = self.ids, self.unit
        q_unit = queries / _lengths(queries)[:, None]
        found, error = estimate(self.codes, self.scalars, q_unit, self.turn)
        own = np.array(ids)[None, :] == np.array(q_ids)[:, None]
        lower, upper = np.where(own, -np.inf, found - error), np.where(own, -np.inf, found + error)
        kth = min(k, len(ids)) - 1
        bar = -np.partition(-lower, kth, axis=1)[:, kth]
        out = []
        for i, q in enumerate(q_ids):
            near = np.flatnonzero((upper[i] >= bar[i]) & ~own[i])
            cosine = (unit[near] * q_unit[i]).sum(axis=1)
            best = sorted(zip((-cosine).tolist(), (ids[j] for j in near.tolist())))[:k]
            out += [(q, v, -c) for c, v in best]
        return out


def met_blocks(vectors: DataFrame, queries: DataFrame, vector_block: int) -> DataFrame:
    """(block, dim, id, v, asks): blocks of about ``vector_block`` vectors by a hash, each followed by all queries."""
    n = max(1, -(-vectors.count() // vector_block))
    dim = F.size("v").alias("dim")
    block = F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(n).cast("bigint")).alias("block")
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint"))).alias("block")
    return side_by_side(vectors.select(block, dim, "id", "v"), queries.select(every, dim, "id", "v"))


def top_k(pairs: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` vectors with the largest cosine to each query, itself left out.

    Queries and vectors meet in blocks of bounded size. Vectors that are null, empty, zero or hold null
    or non-finite components take no part, nor do rows without an id; vectors meet only queries of their
    own length. Repeated rows are searched as often as they occur, a row with the query's id never.
    Ties go to the smaller id. Without candidates a query has no rows.
    """
    base = staged(usable(vectors, id_col, vector_col), "ann-vectors")
    asked = staged(usable(queries, id_col, vector_col), "ann-queries")
    kind = base.schema["id"].dataType.simpleString()
    met = met_blocks(base, asked, VECTOR_BLOCK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, block = None, [], None
        for key, asks, rows in block_runs(batches):
            if key != at:
                at, parts, block = key, [], None
            ids, x = rows.column("id"), as_matrix(rows.column("v"))
            if not asks:
                parts.append((ids.to_pylist(), x))
                continue
            if not parts:
                continue  # no vectors of this length in the block
            if block is None:
                block = Coded([i for p, _ in parts for i in p], np.concatenate([p for _, p in parts]))
            for start in range(0, len(x), QUERY_BLOCK):
                found = block.search(ids[start : start + QUERY_BLOCK].to_pylist(), x[start : start + QUERY_BLOCK], k)
                columns = [pa.array([f[j] for f in found], t) for j, t in enumerate((ids.type, ids.type, pa.float64()))]
                yield pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score"])

    pairs = met.mapInArrow(run, f"query_id {kind}, vec_id {kind}, score double")
    return top_k(pairs, k)


def _unpack(cell: pa.ListScalar) -> tuple[list, np.ndarray]:
    rows = cell.values
    flat = rows.field("v").flatten().to_numpy(zero_copy_only=False)
    return rows.field("id").to_pylist(), flat.reshape(len(rows), -1)
