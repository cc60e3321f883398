"""SimHash near-duplicates found through tables of distances to reference fingerprints.

Every distinct fingerprint gets its Hamming distances to a fixed set of pivots. Eight base pivots
repeat one row of an 8 x 8 Hadamard sign matrix in each of eight byte bands; each base pivot also
comes with one band inverted. For one band, the distances to a base pivot and to its inverted twin
differ by a number that only the bits of that band change, and the eight rows together tell any two
bytes apart. Fingerprints at most two bits apart agree on at least six bands, so they share all
coordinate differences of six bands: those are the join keys. Met pairs are discarded when any
coordinate of their distance tables differs by more than the bit limit, the rest are verified.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from joblattice.llm.shared import as_bytes, components, free_name, never_broadcast, staged

BANDS, MAX_BITS, SHINGLE, SEED = 8, 2, 3, 42
_BLOCK = 1 << 16
_ONES = (1 << 64) - 1


def _signed(value: int) -> int:
    value &= _ONES
    return value - (1 << 64) if value >> 63 else value


def _base_pivots() -> list[int]:
    rows = [sum((bin(r & c).count("1") & 1) << c for c in range(8)) for r in range(8)]
    return [sum(row << (8 * band) for band in range(BANDS)) for row in rows]


def _spread_pivots(n: int = 8) -> list[int]:
    return [xxhash.xxh64_intdigest(b"pivot %d" % i, SEED) for i in range(n)]


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Majority of the shingle hashes, bit by bit; counted in blocks, so memory follows the text's words."""
    words = text.lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))[:n].tolist()
    stops = (ends[min(shingle, len(words)) - 1 :] - 1).tolist()
    digest = xxhash.xxh64_digest
    counts = np.zeros(64, np.int64)
    for at in range(0, n, _BLOCK):
        block = b"".join([digest(joined[s:e], SEED) for s, e in zip(starts[at : at + _BLOCK], stops[at : at + _BLOCK])])
        bits = np.unpackbits(np.frombuffer(block, np.uint8).reshape(-1, 8), axis=1)
        for part in range(0, len(bits), 255):  # sums of at most 255 rows fit a byte
            counts += bits[part : part + 255].sum(axis=0, dtype=np.uint8)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): one row per input row, fp the fingerprint as a signed bigint."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: dict[bytes, int] = {}
            fps = []
            for text in as_bytes(batch.column(1)):
                if text not in known:
                    known[text] = _signed(fingerprint(text, shingle))
                fps.append(known[text])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    return slim.mapInArrow(run, f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, fp bigint")


def _distance(fp: Column, pivot: int) -> Column:
    return F.bit_count(fp.bitwiseXOR(F.lit(_signed(pivot)).cast("bigint")))


def pivot_table(fps: DataFrame) -> DataFrame:
    """Adds ``sig_<band>``, the band's coordinate differences, and ``t0``, ``t1``: packed distances to 16 pivots."""
    fp, base = F.col("fp"), _base_pivots()
    near = [_distance(fp, p) for p in base]
    columns = {}
    for band in range(BANDS):
        flip = 0xFF << (8 * band)
        parts = [((near[j] - _distance(fp, p ^ flip) + 8) / 2).cast("bigint") * (9**j) for j, p in enumerate(base)]
        columns[f"sig_{band}"] = sum(parts[1:], parts[0])
    for name, distances in (("t0", near), ("t1", [_distance(fp, p) for p in _spread_pivots()])):
        packed = [F.shiftleft(d.cast("bigint"), 7 * j) for j, d in enumerate(distances)]
        columns[name] = sum(packed[1:], packed[0])
    return fps.withColumns(columns)


def links(distinct_fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b) with a < b for all fingerprints at most ``max_bits`` apart; ``max_bits`` up to 2."""
    keep = BANDS - max_bits
    keys = F.array(
        *[
            F.xxhash64(F.lit(k), *[F.col(f"sig_{b}") for b in bands])
            for k, bands in enumerate(combinations(range(BANDS), keep))
        ]
    )
    keyed = pivot_table(distinct_fps).select(F.explode(keys).alias("key"), "fp", "t0", "t1")
    left, right = never_broadcast(keyed.alias("l")), never_broadcast(keyed.alias("r"))
    close = F.lit(True)
    for t in ("t0", "t1"):
        for j in range(8):
            one, two = (F.shiftright(F.col(f"{side}.{t}"), 7 * j).bitwiseAND(F.lit(127)) for side in "lr")
            close = close & (F.abs(one - two) <= max_bits)
    sure = F.bit_count(F.col("l.fp").bitwiseXOR(F.col("r.fp"))) <= max_bits
    met = left.join(right, (F.col("l.key") == F.col("r.key")) & (F.col("l.fp") < F.col("r.fp")) & close & sure)
    return met.select(F.col("l.fp").alias("a"), F.col("r.fp").alias("b"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """(doc_id, fp, component_id, n_links): the smallest id that links of at most ``max_bits`` reach.

    Null and blank texts have fingerprint 0 and link like any other. Repeated rows keep one row each.
    Rows without an id take part in links, but never name a component; a component of such rows
    alone has a null id. An empty table gives an empty result. Other columns are not looked at.
    """
    fps = staged(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    classes = fps.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    edges = staged(links(classes.select("fp"), max_bits), "links").distinct()
    labels = components(edges)
    degree = edges.select("a").union(edges.select("b")).groupBy("a").agg(F.count("*").alias("n_links"))
    labelled = classes.join(labels.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "label", F.coalesce("label", "fp")
    )
    lowest = labelled.groupBy("label").agg(F.min("rep").alias("component_id"))
    per_fp = labelled.join(lowest, "label").join(degree.withColumnRenamed("a", "fp"), "fp", "left")
    per_fp = per_fp.select("fp", "component_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return fps.join(per_fp, "fp").select("doc_id", "fp", "component_id", "n_links")


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """The columns of ``docs``, one row of each component: the one with the smallest id.

    Rows without an id name no copy and are all kept; repeated rows of one id leave one.
    """
    found = near_duplicates(docs, **options)
    other = free_name(docs.columns, "_gone")
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias(other)).distinct()
    kept = docs.join(gone, F.col("doc_id") == F.col(other), "left_anti")
    spare = free_name(docs.columns, "_lone")
    lone = F.when(F.col("doc_id").isNull(), F.xxhash64(F.col("text"), F.monotonically_increasing_id())).otherwise(0)
    return kept.withColumn(spare, lone).dropDuplicates(["doc_id", spare]).drop(spare)
