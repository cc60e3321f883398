"""Removal of long passages that an earlier document also holds, found by recompression.

Recompression rewrites a sequence in rounds. A round first names every run of one symbol by the symbol
and the run's length, then splits all symbols into left and right ones and names every pair of a left
and a right symbol. Names are 64-bit hashes of what they stand for, so all tasks give equal names
without talking to each other, and the inside of equal word sequences is rewritten alike wherever
they stand: only a run and at most one more symbol at either end depend on what is around.

So each window of words has, in each round, an inside that its own words fix. In the last round that
leaves it enough symbols, the least and the greatest of them are the window's anchor. Equal windows
have equal anchors, several neighbouring windows share one, and an anchor that Spark meets in one text
only rules out all its windows. For the others the windows themselves are compared, by anchor and
window hash, 128 bits in all. Texts that are equal as a whole are compared once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from joblattice.llm.shared import as_bytes, discard, sharded, staged

WINDOW = 50
#: An inside of fewer symbols is not asked for its anchor any more.
INSIDE = 3
_BLOCK_WORDS = 400_000
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(a: np.ndarray, b: np.ndarray | int) -> np.ndarray:
    """A 64-bit hash of two numbers."""
    x = (a ^ np.uint64(0xD6E8FEB86659FD93)) * _ODD + np.asarray(b, np.uint64)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= _ODD
    return x ^ (x >> np.uint64(32))


def word_names(texts: list[list[bytes]]) -> np.ndarray:
    """The hashes of all words, one text after the other."""
    known: dict[bytes, int] = {}
    out = []
    name = xxhash.xxh64_intdigest
    for words in texts:
        for w in words:
            h = known.get(w)
            if h is None:
                h = known[w] = name(w)
            out.append(h)
    return np.array(out, np.uint64)


def _least(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The least value of each range lo to hi, from minima over powers of two."""
    out = np.empty(len(lo), np.uint64)
    span = np.frexp((hi - lo).astype(np.float64))[1] - 1
    for k in range(int(span.max()) + 1 if len(lo) else 0):
        mine = span == k
        out[mine] = np.minimum(values[lo[mine]], values[hi[mine] - (1 << k)])
        values = np.minimum(values[: len(values) - (1 << k)], values[1 << k :]) if len(values) > 1 << k else values
    return out


def anchors(names: np.ndarray, owner: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(starts, anchor): where windows of words start, and the anchor of each.

    ``owner`` tells the text of each word; no window, run or pair goes over the end of a text.
    """
    n = len(names)
    if n < window:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    starts = np.flatnonzero(owner[: n - window + 1] == owner[window - 1 :])
    anchor = np.zeros(len(starts), np.uint64)
    open_, lo, hi = np.arange(len(starts)), starts.copy(), starts + window
    level = 0
    while len(open_):
        wide = hi - lo >= INSIDE if level else np.ones(len(open_), bool)
        ranked = _mix(names, level)
        low, high = _least(ranked, lo[wide], hi[wide]), ~_least(~ranked, lo[wide], hi[wide])
        anchor[open_[wide]] = _mix(low, high)
        # runs: the first and the last run of an inside may go on outside
        first = np.ones(len(names), bool)
        first[1:] = (names[1:] != names[:-1]) | (owner[1:] != owner[:-1])
        run = np.cumsum(first) - 1
        at = np.flatnonzero(first)
        length = np.diff(np.append(at, len(names)))
        names, owner = names[at], owner[at]
        long = length > 1
        names[long] = _mix(names[long], length[long])
        lo, hi = run[lo] + 1, run[hi - 1]
        # pairs of a left and a right symbol: an end that could pair outside is left off
        right = (_mix(names, level + 1_000_003) >> np.uint64(40)) & np.uint64(1) == 1
        keep = lo < hi
        open_, lo, hi = open_[keep], lo[keep], hi[keep]
        lo = lo + right[lo]
        hi = hi - ~right[hi - 1]
        keep = lo < hi
        open_, lo, hi = open_[keep], lo[keep], hi[keep]
        pair = np.zeros(len(names), bool)
        pair[:-1] = ~right[:-1] & right[1:] & (owner[1:] == owner[:-1])
        at = np.flatnonzero(pair)
        named = names.copy()
        named[at] = _mix(names[at], names[at + 1])
        stay = np.ones(len(names), bool)
        stay[at + 1] = False
        new = np.cumsum(stay) - 1
        names, owner = named[stay], owner[stay]
        lo, hi = new[lo], new[hi - 1] + 1
        level += 1
    return starts, anchor


def window_hashes(names: np.ndarray, starts: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """A polynomial hash modulo 2**64 of the window at each start."""
    with np.errstate(over="ignore"):
        powers = np.full(len(names) + 1, _ODD, np.uint64)
        powers[0] = 1
        powers = np.cumprod(powers)
        inverse = np.full(len(names) + 1, np.uint64(pow(int(_ODD), -1, 1 << 64)), np.uint64)
        inverse[0] = 1
        inverse = np.cumprod(inverse)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_mix(names, 17) * powers[:-1])))
        return _mix((sums[starts + window] - sums[starts]) * inverse[starts], 5)


def _blocks(batch: pa.RecordBatch, text_at: int) -> Iterator[tuple[list[int], list[list[bytes]], np.ndarray]]:
    """Rows of a batch in blocks of bounded size, a long text alone: row numbers, words, owner of each word."""
    texts = as_bytes(batch.column(text_at))
    for a, b in sharded(np.array([len(t) // 5 + 1 for t in texts]), _BLOCK_WORDS):
        words = [t.split() for t in texts[a:b]]
        yield list(range(a, b)), words, np.repeat(np.arange(b - a), [len(w) for w in words])


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def find_anchors(texts: DataFrame, window: int = WINDOW) -> DataFrame:
    """(key, tid): each anchor of each text once; ``texts`` has tid and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, words, owner in _blocks(batch, 1):
                starts, key = anchors(word_names(words), owner, window)
                if not len(starts):
                    continue
                by = owner[starts]
                fresh = np.ones(len(key), bool)
                order = np.lexsort((key, by))
                fresh[1:] = (key[order][1:] != key[order][:-1]) | (by[order][1:] != by[order][:-1])
                kept = order[fresh]
                ids = batch.column(0).take(pa.array(np.array(rows)[by[kept]]))
                yield pa.RecordBatch.from_arrays([_signed(key[kept]), ids], ["key", "tid"])

    return texts.mapInArrow(run, "key bigint, tid bigint")


def find_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(key, hash, doc, start) of the windows whose anchor is among ``keys`` of their row (doc, text, keys)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column(2)
            for rows, words, owner in _blocks(batch, 1):
                names = word_names(words)
                starts, key = anchors(names, owner, window)
                if not len(starts):
                    continue
                ends = np.searchsorted(owner[starts], np.arange(len(rows) + 1))
                keep = np.zeros(len(starts), bool)
                for i, row in enumerate(rows):
                    mine = slice(ends[i], ends[i + 1])
                    keys = np.asarray(wanted[row].values.to_numpy(zero_copy_only=False), np.int64).view(np.uint64)
                    keep[mine] = np.isin(key[mine], keys)
                starts, key = starts[keep], key[keep]
                by = owner[starts]
                first = np.searchsorted(owner, np.arange(len(rows)))
                ids = batch.column(0).take(pa.array(np.array(rows)[by]))
                places = pa.array((starts - first[by]).astype(np.int32))
                hashes = window_hashes(names, starts, window)
                yield pa.RecordBatch.from_arrays([_signed(key), _signed(hashes), ids, places], ["key", "hash", "doc", "start"])

    kind = docs.schema[0].dataType.simpleString()
    return docs.mapInArrow(run, f"key bigint, hash bigint, doc {kind}, start int")


def _kept(words: list[bytes], starts: list[int], window: int) -> tuple[bytes, int]:
    cover = np.zeros(len(words) + 1, np.int64)
    at = np.asarray(starts, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + window, -1)
    gone = np.cumsum(cover[:-1]) > 0
    return b" ".join([w for w, g in zip(words, gone.tolist()) if not g]), int(gone.sum())


def fates(slim: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc, tid, whole, starts): whether the text is that of a smaller id, else where its late windows start."""
    ids = slim.where("doc is not null").select("doc", "tid", F.md5("text").alias("sum"))
    ids = ids.groupBy("doc").agg(F.min(F.struct("tid", "sum")).alias("t")).select("doc", "t.tid", "t.sum")
    ids = staged(ids, "text-ids")
    first = ids.groupBy("sum").agg(F.min("doc").alias("first"))
    ids = ids.join(first, "sum").select("doc", "tid", (F.col("first") < F.col("doc")).alias("whole"))

    found = staged(find_anchors(slim.select("tid", "text"), window), "anchors")
    shared = found.groupBy("key").agg(F.min("tid").alias("low"), F.max("tid").alias("high"))
    shared = shared.where("low < high").select("key")
    keys = found.join(shared, "key", "left_semi").groupBy("tid").agg(F.collect_set("key").alias("keys"))
    wanted = ids.where("not whole").join(keys, "tid")
    windows = staged(find_windows(slim.join(wanted, ["doc", "tid"]).select("doc", "text", "keys"), window), "windows")
    discard(found)
    low = windows.groupBy("key", "hash").agg(F.min("doc").alias("low"))
    late = windows.join(low, ["key", "hash"]).where("low < doc")
    late = late.groupBy("doc").agg(F.collect_set("start").alias("starts"))
    out = staged(ids.join(late, "doc", "left"), "fates")
    discard(windows)
    return out


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept (the words left), kept_sha256.

    A word goes if a window of ``window`` words that covers it also starts in a document with a smaller
    id; windows are those of the input. Null and empty texts have no words and the hash of nothing.
    Rows without an id neither lose words nor make others lose any. Rows that repeat an id and text count
    as one document; of different texts under one id one takes part, that with the smallest hash, and the
    others keep all words. Other columns are not looked at.
    """
    text = F.col(text_col)
    slim = docs.select(F.col(id_col).alias("doc"), text.alias("text"), F.xxhash64(text).alias("tid"))
    fate = fates(slim.where("text is not null"), window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, whole, starts = as_bytes(batch.column(1)), batch.column(2).to_pylist(), batch.column(3)
            n, removed, kept = [], [], []
            for i, text in enumerate(texts):
                words = text.split()
                late = starts[i].as_py() if starts[i].is_valid else ()
                if whole[i]:
                    left, gone = (b"", len(words)) if len(words) >= window else (b" ".join(words), 0)
                else:
                    left, gone = _kept(words, late, window) if late else (b" ".join(words), 0)
                n.append(len(words))
                removed.append(gone)
                kept.append(left)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                    pa.array([hashlib.sha256(k).hexdigest() for k in kept]),
                ],
                ["doc_id", "n_words", "n_removed", "kept", "kept_sha256"],
            )

    kind = slim.schema["doc"].dataType.simpleString()
    joined = slim.join(fate, ["doc", "tid"], "left").select("doc", "text", "whole", "starts")
    return joined.mapInArrow(run, f"doc_id {kind}, n_words bigint, n_removed bigint, kept string, kept_sha256 string")
