"""Hard negatives by the threshold algorithm over sorted lists.

Candidates are dealt to blocks by label, hot labels to several. A block keeps, for every dimension, its
rows in the order of that component. An anchor reads all lists in parallel, from the top where its own
component is positive and from the bottom where it is negative; each row met for the first time is
scored whole by random access. What no list has shown yet scores at most the anchor times the
components at the present depth, the threshold. Reading stops once the threshold is strictly below the
k-th best score of each window searched, or below the window. An anchor first meets the blocks of its
own label for its positives, then all blocks for the rows of other labels inside each positive's window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from joblattice.llm.shared import as_matrix, block_runs, forgotten_shuffles, side_by_side, staged
from joblattice.session import broadcast_if_small

#: Rows of a block and of one label's share of a block, as dealt by hash; anchors side by side.
BLOCK, SHARE, ANCHORS = 4096, 2048, 128
#: Vectors with a larger component take no part: their products exceed 38 digits.
LARGEST = float(1 << 40)
#: The first step reads so many rows of each list, each further one so many times as many as the last.
FIRST_DEPTH, FURTHER = 16, 4


class Lists:
    """The candidates of a block with their order by each component."""

    def __init__(self, ids: list, labels: list, vectors: np.ndarray, largest_anchor: int):
        self.ids, self.vectors = ids, vectors
        self.fit(largest_anchor)
        self.order = np.ascontiguousarray(np.argsort(vectors, axis=0, kind="stable").T)
        self.code = {label: i for i, label in enumerate(dict.fromkeys(labels))}
        self.labels = np.array([self.code[label] for label in labels])
        self.rows: dict = {}
        for i, r in enumerate(ids):
            self.rows.setdefault(r, []).append(i)
        self.reads = 0

    def fit(self, largest_anchor: int) -> None:
        """Make the scores of anchors with components up to that one exact."""
        self.x = exact(self.vectors, largest_anchor)

    def eligible(self, own_id, own_label, same_label: bool) -> np.ndarray:
        """The rows with the same label or with others, never those of the anchor's id."""
        out = (self.labels == self.code.get(own_label, -1)) == same_label
        out[self.rows.get(own_id, [])] = False
        return out

    def search(self, anchor: np.ndarray, eligible: np.ndarray, windows: list[tuple[int | None, int | None]], k: int) -> list[list]:
        """For each window (low, high) the first ``k`` (score, id) of the eligible rows inside it."""
        a = anchor.astype(self.x.dtype)
        up, down = np.flatnonzero(a > 0), np.flatnonzero(a < 0)
        n = len(self.x)
        seen = np.zeros(n, bool)
        rows, scores = np.empty(0, np.int64), np.empty(0, self.x.dtype)
        start, step, threshold = 0, FIRST_DEPTH, None
        found: list[list] = [[] for _ in windows]
        open_ = [i for i, (low, high) in enumerate(windows) if low is None or low <= high]
        while open_:
            met = np.zeros(n, bool)
            if start < n and len(up) + len(down):
                end = min(start + step, n)
                met[self.order[up, n - end : n - start]] = True
                met[self.order[down, start:end]] = True
                met &= ~seen
                seen |= met
                threshold = int((a[up] * self.x[self.order[up, n - end], up]).sum() + (a[down] * self.x[self.order[down, end - 1], down]).sum())
                done = bool(seen.all())
            else:  # an anchor of zeros has no lists: every row scores 0
                met, done = ~seen, True
            self.reads += int(met.sum())
            new = np.flatnonzero(met & eligible)
            rows, scores = np.concatenate([rows, new]), np.concatenate([scores, self.x[new] @ a])
            start, step = start + step, FURTHER * step
            for i in list(open_):
                low, high = windows[i]
                if not done and high is not None and threshold >= high:
                    continue  # rows of the window may still be unseen
                inside = np.ones(len(rows), bool) if high is None else (scores <= high) & (scores >= low)
                mine = np.flatnonzero(inside)
                kth = None
                if len(mine) >= k:
                    kth = np.partition(scores[mine], len(mine) - k)[len(mine) - k]
                if done or (kth is not None and threshold < kth) or (low is not None and threshold < low):
                    mine = mine if kth is None else mine[scores[mine] >= kth]
                    best = sorted((-int(scores[m]), self.ids[rows[m]]) for m in mine)
                    found[i] = [(-s, r) for s, r in best[:k]]
                    open_.remove(i)
        return found


def exact(whole: np.ndarray, other: int) -> np.ndarray:
    """In the fastest type that holds inner products with vectors of components up to ``other``."""
    top = int(np.abs(whole).max(initial=0)) * other * whole.shape[1]
    return whole.astype(np.float64 if top < 1 << 53 else np.int64 if top < 1 << 63 else object)


def _searched(blocks: DataFrame, anchors: DataFrame, k: int, same_label: bool, id_kind: str, low: int = 0, high: int = 0) -> DataFrame:
    """(a, window, id, score): for each anchor and window the first rows of one block.

    ``blocks`` holds the rows of all blocks, ``anchors`` a row for each anchor and block it meets. Each score in an
    anchor's list ``windows`` makes a window from ``low`` to ``high`` percent of it; without a list, all scores are searched.
    """
    schema = f"a bigint, window int, id {id_kind}, score decimal(38,0)"
    kinds = [pa.int64(), pa.int32(), None, pa.decimal128(38, 0)]
    columns = ["block", "dim", "id", "label", "v"]
    lone = {"a": F.lit(None).cast("bigint"), "windows": F.lit(None).cast("array<decimal(38,0)>")}
    met = side_by_side(blocks.select(*columns).withColumns(lone), anchors.select(*columns, *lone))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, lists = None, [], None
        for key, asks, rows in block_runs(batches):
            if key != at:
                at, parts, lists = key, [], None
            if not asks:
                parts.append((rows.column("id").to_pylist(), rows.column("label").to_pylist(), as_matrix(rows.column("v"))))
                continue
            if not parts:
                continue  # no rows of this length in the block
            if lists is None:
                ids, labels, x = zip(*parts)
                lists = Lists([i for p in ids for i in p], [i for p in labels for i in p], np.concatenate(x), 0)
            for start in range(0, rows.num_rows, ANCHORS):
                some = rows.slice(start, ANCHORS)
                numbers, own, own_labels, windows = (some.column(c).to_pylist() for c in ("a", "id", "label", "windows"))
                x = as_matrix(some.column("v"))
                lists.fit(int(np.abs(x).max(initial=0)))
                out = []
                for j, number in enumerate(numbers):
                    eligible = lists.eligible(own[j], own_labels[j], same_label)
                    of = [int(s) for s in windows[j] or ()]
                    bounds = [(-(-s * low // 100), s * high // 100) for s in of] or [(None, None)]
                    for w, found in enumerate(lists.search(x[j], eligible, bounds, k)):
                        out += [(number, w, r, s) for s, r in found]
                types = [t or rows.column("id").type for t in kinds]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[c] if c < 3 else int(o[c]) for o in out], types[c]) for c in range(4)], ["a", "window", "id", "score"]
                )

    return met.mapInArrow(run, schema)


def _best(pairs: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("a", "window").orderBy(F.desc("score"), "id")
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    n_positives: int = 5,
    n_negatives: int = 3,
    low: int = 50,
    high: int = 95,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Scores are inner products of floor(scale * x); higher come first, ties by the smaller id. The
    positives of an anchor, a row where ``is_anchor`` holds, are its first ``n_positives`` other rows of
    the same label; for each, the first ``n_negatives`` rows of other labels whose score lies between
    ``low`` and ``high`` percent of the positive's are returned. All of them are found, whatever the blocks.

    Rows without an id, label or vector, with an empty vector or with a null or non-finite component or
    one of 2^40 and more take no part; vectors meet those of their own length. Repeated rows count as
    often as they occur, as anchors too; a row with the anchor's id is never its own. Scores beyond 64 bits
    come out null. Empty tables give no rows; other columns are not looked at.
    """
    whole = F.transform(F.col(vector_col).cast("array<double>"), lambda x: x * float(scale))
    rows = vectors.select(
        F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"), whole.alias("w")
    ).where("id IS NOT NULL AND label IS NOT NULL AND w IS NOT NULL AND size(w) > 0")
    rows = rows.where(F.forall("w", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LARGEST * scale)))
    v = F.transform("w", lambda x: F.floor(x).cast("bigint")).alias("v")
    a = F.monotonically_increasing_id().alias("a")
    base = staged(rows.select(a, "id", "label", "anchor", F.size("w").alias("dim"), v), "negatives-vectors")
    n_blocks = max(1, -(-base.count() // BLOCK))
    id_kind = base.schema["id"].dataType.simpleString()

    def home(share: Column) -> Column:
        return F.pmod(F.xxhash64("label", share), F.lit(n_blocks))

    shares = F.ceil(F.count("*") / SHARE).alias("shares")
    labels = broadcast_if_small(staged(base.groupBy("label").agg(shares), "negatives-labels"))
    placed = base.join(labels, "label").withColumn("block", home(F.pmod(F.xxhash64("a"), F.col("shares"))))
    blocks = staged(placed.select("block", "dim", "id", "label", "v"), "negatives-blocks")

    asked = base.where("anchor").withColumn("windows", F.lit(None).cast("array<decimal(38,0)>"))
    at = F.array_distinct(F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("shares") - 1), home))
    near = asked.join(labels, "label").withColumn("block", F.explode(at))
    found = _searched(blocks, near, n_positives, True, id_kind)
    with forgotten_shuffles(base.sparkSession):
        positives = staged(_best(found, n_positives).select("a", "rank", "id", "score"), "negatives-positives")

    scored = F.struct("rank", "id", "score")
    ranked = positives.groupBy("a").agg(F.array_sort(F.collect_list(scored)).alias("positives"))  # n_positives at most
    searching = base.where("anchor").drop("anchor").join(ranked, "a")
    searching = staged(searching.withColumn("windows", F.col("positives.score")), "negatives-anchors")
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_blocks - 1).cast("bigint")))
    found = _best(_searched(blocks, searching.withColumn("block", every), n_negatives, False, id_kind, low, high), n_negatives)
    found = found.select("a", "window", "rank", F.col("id").alias("negative"), F.col("score").alias("reached"))
    out = found.join(searching.select("a", "id", "positives"), "a")
    out = out.withColumn("positive", F.element_at("positives", F.col("window") + 1))
    return out.select(
        F.col("id").alias("anchor_id"),
        F.col("positive.id").alias("positive_id"),
        F.col("rank").cast("int").alias("rank"),
        F.col("negative").alias("negative_id"),
        F.expr("try_cast(positive.score AS bigint)").alias("positive_score"),
        F.expr("try_cast(reached AS bigint)").alias("negative_score"),
    )
