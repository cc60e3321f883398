"""Exact top-k inner products over M-trees.

A vector x of a set whose longest vector has length R gets the extra coordinate sqrt(R^2 - |x|^2), a
query q the extra coordinate 0; then d(q, x)^2 = |q|^2 + R^2 - 2 <q, x>, and the largest inner product
is the smallest distance. Vectors are dealt to pages around routing vectors of a bounded sample, hot
ones split, and each page becomes an M-tree: nodes of few entries with a routing vector, a covering
radius and the distance to the parent's routing vector. The search opens the node with the smallest
possible distance first. Where |d(q, parent) - d(entry, parent)| less the radius already exceeds the
k-th best distance, the entry is skipped before its own distance is computed.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from joblattice.llm.ann import _unpack, top_k, usable
from joblattice.llm.shared import hash_sample, staged

#: Routing vectors come from a sample of at most this many rows, chosen by a hash of the id.
ROUTES, FIRST_BOUND = 16, 512
PAGE, FANOUT, TREE_SIZE, QUERY_BLOCK = 256, 16, 4096, 256
#: Below this squared length of every vector, sums of products are exact in double precision.
EXACT = 1 << 52


class Tree:
    """An M-tree over integer vectors; nodes are rows of flat lists."""

    def __init__(self, ids: list, vectors: np.ndarray, longest: int):
        self.ids, self.x, self.longest = ids, vectors, float(longest)
        self.norms = (vectors * vectors).sum(axis=1)
        self.extra = np.sqrt(np.maximum(longest - self.norms, 0).astype(np.float64))
        self.pivot: list[int] = []
        self.radius: list[float] = []
        self.children: list[np.ndarray | None] = []
        self.entries: list[np.ndarray | None] = []
        self.to_parent: list[np.ndarray] = []  # of the children or entries, to this node's pivot
        self.block: list[np.ndarray | None] = []  # the entries' or children's vectors side by side
        rows = np.arange(len(ids))
        self.root = self._build(rows, 0, self._distances(0, rows))
        self.below = [None if c is None else np.array([self.radius[i] for i in c]) for c in self.children]
        self.slack = 1e-7 * (1.0 + math.sqrt(self.longest))

    def _distances(self, pivot: int, rows: np.ndarray) -> np.ndarray:
        dots = self.x[rows] @ self.x[pivot]
        gap = self.norms[rows] + self.norms[pivot] - 2 * dots
        return np.sqrt(gap + (self.extra[rows] - self.extra[pivot]) ** 2)

    def _build(self, rows: np.ndarray, pivot: int, far: np.ndarray) -> int:
        """A node over ``rows``, whose distances to its pivot are ``far``."""
        if len(rows) <= PAGE:
            return self._node(pivot, far, None, rows, far)
        pivots, near, own = [], np.full(len(rows), np.inf), np.zeros(len(rows), np.int64)
        nearest = int(np.argmax(far))
        for i in range(FANOUT):  # each further pivot is the row farthest from those so far
            pivots.append(int(rows[nearest]))
            d = self._distances(pivots[-1], rows)
            closer = d < near
            near[closer], own[closer] = d[closer], i
            nearest = int(np.argmax(near))
            if near[nearest] <= 0:
                break
        children = []
        if len(pivots) == 1:  # all rows alike: cut evenly
            for part in np.array_split(np.arange(len(rows)), -(-len(rows) // PAGE)):
                children.append((pivots[0], self._build(rows[part], pivots[0], near[part])))
        else:
            for i, p in enumerate(pivots):
                mine = np.flatnonzero(own == i)
                if len(mine):
                    children.append((p, self._build(rows[mine], p, near[mine])))
        nodes = np.array([c for _, c in children])
        return self._node(pivot, far, nodes, None, self._distances(pivot, np.array([p for p, _ in children])))

    def _node(self, pivot: int, far: np.ndarray, children, entries, to_parent: np.ndarray) -> int:
        self.pivot.append(pivot)
        self.radius.append(float(far.max()) if len(far) else 0.0)
        self.children.append(children)
        self.entries.append(entries)
        self.to_parent.append(to_parent)
        rows = entries if children is None else np.array([self.pivot[c] for c in children], np.int64)
        self.block.append(self.x[rows].astype(np.float64) if self.longest < EXACT else self.x[rows])
        return len(self.pivot) - 1

    def search(self, q_id, q: np.ndarray, k: int, floor: int | None) -> list[tuple[int, object]]:
        """The best (score, id), ``floor`` a score that k other rows are known to reach."""
        norm = int((q * q).sum())
        base = norm + self.longest
        q = q.astype(np.float64) if norm < EXACT and self.longest < EXACT else q

        def away(dots: np.ndarray) -> np.ndarray:
            return np.sqrt(np.maximum(base - 2.0 * dots, 0.0))

        best: list[tuple[int, object]] = []  # (score less than 0, id), best first
        bar = math.inf if floor is None else math.sqrt(max(base - 2.0 * floor, 0.0)) + self.slack
        at = float(away(self.x[self.pivot[self.root]] @ q))
        heap = [(max(at - self.radius[self.root], 0.0), self.root, at)]
        while heap:
            least, node, at = heapq.heappop(heap)
            if least > bar:
                break
            gap = np.abs(at - self.to_parent[node])
            block, children = self.block[node], self.children[node]
            if children is not None:
                open_ = np.flatnonzero(gap - self.below[node] <= bar)
                d = away((block if len(open_) == len(block) else block[open_]) @ q)
                for c, dist, r in zip(children[open_].tolist(), d.tolist(), self.below[node][open_].tolist()):
                    if dist - r <= bar:
                        heapq.heappush(heap, (max(dist - r, 0.0), c, dist))
                continue
            open_ = np.flatnonzero(gap <= bar)
            scores = (block if len(open_) == len(block) else block[open_]) @ q
            if len(best) == k:
                good = scores >= -best[-1][0]
                open_, scores = open_[good], scores[good]
            elif floor is not None:
                good = scores >= floor
                open_, scores = open_[good], scores[good]
            if not len(open_):
                continue
            rows = self.entries[node][open_].tolist()
            found = [(-int(s), self.ids[r]) for s, r in zip(scores.tolist(), rows) if self.ids[r] != q_id]
            best = heapq.nsmallest(k, best + found)
            if len(best) == k:
                bar = min(bar, math.sqrt(max(base + 2.0 * best[-1][0], 0.0)) + self.slack)
        return [(-s, i) for s, i in best]


def whole(rows: DataFrame) -> DataFrame:
    """(id, v): floor(256 x) of each component."""
    return rows.select("id", F.transform("v", lambda x: F.floor(x * 256.0).cast("bigint")).alias("v"))


def _integers(cell) -> tuple[list, np.ndarray]:
    ids, x = _unpack(cell)
    return ids, x.astype(np.int64, copy=False)


def _sample(rows: DataFrame, n: int) -> tuple[list, dict[int, np.ndarray]]:
    """At most ``n`` rows by a hash of their ids: the ids, and their vectors by length."""
    found = sorted(hash_sample(rows, F.col("id"), n).collect(), key=lambda r: r["id"])
    by: dict[int, list] = {}
    for r in found:
        by.setdefault(len(r["v"]), []).append((r["id"], list(r["v"])))
    return [r["id"] for r in found], {d: ([i for i, _ in v], np.array([x for _, x in v], np.int64)) for d, v in by.items()}


def routed(rows: DataFrame, sample: dict) -> DataFrame:
    """Adds the number of the nearest of the first ``ROUTES`` sampled vectors of the same length."""
    routes = {d: x[:ROUTES] for d, (_, x) in sample.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for v in batch.column(1).to_pylist():
                x = np.array(v, np.int64)
                known = routes.get(len(v))
                out.append(0 if known is None else int(((known - x).astype(np.float64) ** 2).sum(axis=1).argmin()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int32())], ["id", "v", "route"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, v array<bigint>, route int")


def top_inner_products(
    vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` largest inner products of floor(256 x), exact.

    A query's own id is left out; ties go to the smaller id. Vectors that are null, empty or hold null or
    non-finite components take no part, nor do rows without an id; vectors meet only queries of their
    length. Repeated rows count as often as they occur. Components must keep inner products within 64 bits.
    """
    base = staged(whole(usable(vectors, id_col, vector_col, nonzero=False)), "mtree-vectors")
    asked = staged(whole(usable(queries, id_col, vector_col, nonzero=False)), "mtree-queries")
    norm = F.aggregate("v", F.lit(0).cast("bigint"), lambda a, x: a + x * x)
    longest = base.select(norm.alias("n")).agg(F.max("n")).first()[0] or 0
    _, sample = _sample(base, FIRST_BOUND)
    placed = staged(routed(base, sample), "mtree-pages")
    dim = F.size("v").alias("dim")
    counts = placed.groupBy("route", dim).count().collect()  # at most ROUTES rows for each vector length
    first, splits = 0, []
    for r in sorted((c["route"], c["dim"], c["count"]) for c in counts):
        n = -(-r[2] // TREE_SIZE)
        splits.append((r[0], r[1], first, n))
        first += n
    spark, kind = base.sparkSession, base.schema["id"].dataType.simpleString()
    layout = spark.createDataFrame(splits, "route int, dim int, first bigint, n bigint")
    page = F.col("first") + F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.col("n"))
    pages = placed.withColumn("dim", F.size("v")).join(F.broadcast(layout), ["route", "dim"]).withColumn("page", page)
    pages = pages.groupBy("page", "dim").agg(F.collect_list(F.struct("id", "v")).alias("vectors"))
    n_blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    blocks = asked.withColumn("b", F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(n_blocks)))
    blocks = blocks.groupBy("b", dim).agg(F.collect_list(F.struct("id", "v")).alias("queries")).drop("b")
    spread = layout.select("dim", F.explode(F.sequence("first", F.col("first") + F.col("n") - 1)).alias("page"))
    met = pages.join(blocks.join(spread, "dim"), ["page", "dim"]).select("page", "vectors", "queries")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tree = None, None
        for batch in batches:
            id_type = batch.schema.field(1).type.value_type.field("id").type
            for i in range(batch.num_rows):
                if batch.column(0)[i].as_py() != held:
                    held = batch.column(0)[i].as_py()
                    tree = Tree(*_integers(batch.column(1)[i]), longest)
                q_ids, q = _integers(batch.column(2)[i])
                s_ids, s = sample.get(q.shape[1], ([], np.zeros((0, q.shape[1]), np.int64)))
                others = np.array(s_ids)[None, :] != np.array(q_ids)[:, None]
                known = q @ s.T
                rows = []
                for j, q_id in enumerate(q_ids):
                    seen = np.sort(known[j][others[j]]) if len(s_ids) else ()
                    floor = int(seen[-k]) if len(seen) >= k else None
                    rows += [(q_id, v, score) for score, v in tree.search(q_id, q[j], k, floor)]
                columns = [pa.array([r[c] for r in rows], t) for c, t in enumerate((id_type, id_type, pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score"])

    return top_k(met.mapInArrow(run, f"query_id {kind}, vec_id {kind}, score bigint"), k)
