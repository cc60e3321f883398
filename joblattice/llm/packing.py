"""Conflict-constrained best-fit packing of documents into fixed-size bins.

A document longer than a bin is cut into full pieces and a rest. Pieces are spread over groups of
bounded expected size; each group is packed on its own, largest piece first. Its open bins are kept
in order of what is left in them and carry bitmaps of the sources and duplicate clusters they hold.
The search starts at the tightest bin that is large enough and goes on to its successors until one
shares neither source nor cluster with the piece; if none does, a new bin is opened.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from joblattice.llm import simhash
from joblattice.llm.shared import WORD, components, staged

CAPACITY, GROUP_PIECES = 4096, 4096


def best_fit(pieces: Iterable[tuple[int, int | None, int | None]], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of each (size, source, cluster), in the order given; None conflicts with nothing."""
    bins: list[tuple[int, int]] = []  # (what is left, bin), in order
    held: list[list[int]] = []  # bitmaps of sources and clusters by bin
    out = []
    for size, source, cluster in pieces:
        s_bit = 0 if source is None else 1 << source
        c_bit = 0 if cluster is None else 1 << cluster
        at = bisect_left(bins, (size, -1))
        while at < len(bins) and (held[bins[at][1]][0] & s_bit or held[bins[at][1]][1] & c_bit):
            at += 1
        if at < len(bins):
            left, number = bins.pop(at)
        else:
            left, number = capacity, len(held)
            held.append([0, 0])
        held[number][0] |= s_bit
        held[number][1] |= c_bit
        out.append((number, capacity - left))
        if left > size:
            insort(bins, (left - size, number))
    return out


def _codes(values: list) -> list[int | None]:
    """Small numbers for values that occur, None for nulls."""
    numbers: dict = {}
    return [None if v is None else numbers.setdefault(v, len(numbers)) for v in values]


def text_cluster(text: Column) -> Column:
    """A cluster of exact copies up to letter case and white space; null for texts without words."""
    plain = F.trim(F.regexp_replace(F.lower(text), r"[\x20\x09-\x0D]+", " "))
    return F.when(plain != "", F.xxhash64(plain))


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0))


def near_clusters(docs: DataFrame) -> DataFrame:
    """doc_id, source, size and cluster of each row; near copies share a cluster.

    A cluster is what links between fingerprints of lower-cased texts reach, as in
    ``simhash.near_duplicates``, so it holds exact copies up to letter case and white space too. Texts
    without words have a null cluster.
    """
    row = F.struct("doc_id", F.col("source").cast("string").alias("source"), n_words(F.col("text")).alias("size"))
    marked = simhash.fingerprints(docs.select(row.alias("row"), F.lower("text").alias("text")), "row")
    fps = staged(marked.select("doc_id.*", "fp"), "pack-fingerprints")
    edges = staged(simhash.links(fps.where("size > 0").select("fp").distinct()), "pack-links").distinct()
    met = fps.join(components(edges).withColumnRenamed("node", "fp"), "fp", "left")
    return met.select("doc_id", "source", "size", F.when(F.col("size") > 0, F.coalesce("label", "fp")).alias("cluster"))


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    cluster: Column | None = None,
    source: Column | None = None,
    size: Column | None = None,
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, n_tokens, bin_id, bin_offset, source, cluster.

    ``size`` defaults to the number of words, ``cluster`` to exact copies (``near_clusters`` finds near
    ones), ``source`` to the column of that name. Rows of size 0 (null, empty, blank texts) get one row with a null bin, so that each row
    of ``docs`` shows up. Null sources and clusters conflict with nothing. Repeated rows are packed as
    often as they occur; equal sizes go in the order of id, then piece. No two pieces of one source or
    one cluster share a bin; full pieces of long documents fill bins of their own.
    """
    text = F.col("text")
    size = n_words(text) if size is None else size
    slim = docs.select(
        F.col("doc_id").alias("doc_id"),
        size.cast("bigint").alias("size"),
        (F.col("source") if source is None else source).cast("string").alias("source"),
        (text_cluster(text) if cluster is None else cluster).cast("bigint").alias("cluster"),
    )
    slim = staged(slim, "pack")
    total = slim.agg(F.sum(F.ceil(F.col("size") / capacity))).first()[0] or 0
    groups = max(1, math.ceil(int(total) / group_pieces))
    full = F.floor(F.col("size") / capacity)
    number = F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("size") / capacity).cast("bigint") - 1, F.lit(0))))
    rows = slim.withColumn("salt", F.monotonically_increasing_id()).withColumn("piece", number)
    rows = rows.withColumn("start", F.col("piece") * capacity)
    rows = rows.withColumn("n_tokens", F.least(F.lit(capacity), F.col("size") - F.col("start")))
    whole = (F.col("piece") < full) & (F.col("size") > 0)
    rows = rows.withColumn("grp", F.pmod(F.xxhash64("doc_id", "salt", "piece"), F.lit(groups)).cast("int"))
    names = ["doc_id", "piece", "start", "n_tokens", "bin_id", "bin_offset", "source", "cluster"]
    kind = slim.schema["doc_id"].dataType.simpleString()
    # a piece that fills a bin, or has no words, needs no search
    own = rows.where(whole | (F.col("size") == 0)).select(
        "doc_id", "piece", "start", "n_tokens",
        F.when(whole, F.concat_ws("-", F.lit("f"), "salt", "piece")).alias("bin_id"),
        F.when(whole, F.lit(0).cast("bigint")).alias("bin_offset"), "source", "cluster",
    )

    def run(pieces: pa.Table) -> pa.Table:
        rows = pieces.to_pylist()
        rows.sort(key=lambda r: (-r["n_tokens"], r["doc_id"] is None, r["doc_id"] or 0, r["piece"], r["salt"]))
        sources, clusters = (_codes([r[c] for r in rows]) for c in ("source", "cluster"))
        placed = best_fit(zip([r["n_tokens"] for r in rows], sources, clusters), capacity)
        for row, (number, offset) in zip(rows, placed):
            row["bin_id"], row["bin_offset"] = f"b-{row['grp']}-{number}", offset
        kinds = {"bin_id": pa.string(), "bin_offset": pa.int64()}
        return pa.table({n: pa.array([r[n] for r in rows], kinds.get(n) or pieces.schema.field(n).type) for n in names})

    rest = rows.where(~whole & (F.col("size") > 0)).select(
        "grp", "doc_id", "piece", "start", "n_tokens", "source", "cluster", "salt"
    )
    schema = (
        f"doc_id {kind}, piece bigint, start bigint, n_tokens bigint, bin_id string, bin_offset bigint,"
        " source string, cluster bigint"
    )
    return rest.groupBy("grp").applyInArrow(run, schema).unionByName(own)
