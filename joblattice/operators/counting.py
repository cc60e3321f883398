"""N-grams of word lists counted inside tasks, a chunk of texts at a time.

Words of a chunk are numbered, n-grams are numbers made of them, and equal numbers are counted by sorting
them; a string is built once for each n-gram of a chunk. An n-gram also has a bucket, made of its words'
checksums alone, so that all tasks agree on it: the sum over a bucket is never below the count of a term in it.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks bring this code along; workers need no copy of the package

WORDS = "words"
BUCKET_BITS = 20
BUCKETS = 1 << BUCKET_BITS
CHUNK_WORDS = 1 << 19
_MIX = np.uint64(0x9E3779B97F4A7C15)
_DOWN = np.uint64(64 - BUCKET_BITS)
_PAIR = [T.StructField("term", T.StringType()), T.StructField("tf", T.LongType())]


def _checksums(words: pa.Array) -> np.ndarray:
    return np.fromiter((zlib.crc32(w) for w in words.cast(pa.binary()).to_pylist()), np.uint64, len(words))


def buckets_of(terms: list[str]) -> np.ndarray:
    """The bucket of each term, whose words are parted by single blanks."""
    out = np.zeros(len(terms), np.int64)
    for i, term in enumerate(terms):
        folded = 0
        for word in term.split(" "):
            folded = (folded ^ zlib.crc32(word.encode())) * int(_MIX) & (1 << 64) - 1
        out[i] = folded >> int(_DOWN)
    return out


def packed(buckets: np.ndarray) -> bytes:
    """A set of buckets as one bit each."""
    held = np.zeros(BUCKETS, bool)
    held[buckets] = True
    return np.packbits(held).tobytes()


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order, about ``CHUNK_WORDS`` words at a time; a longer text is a chunk of its own."""
    for batch in batches:
        sizes = pc.fill_null(pc.list_value_length(batch.column(WORDS)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            limit = (ends[at - 1] if at else 0) + CHUNK_WORDS
            stop = max(int(np.searchsorted(ends, limit, side="right")), at + 1)
            yield batch.slice(at, stop - at)
            at = stop


class _Chunk:
    """The words of some rows as numbers."""

    def __init__(self, batch: pa.RecordBatch):
        lists = batch.column(WORDS)
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        coded = lists.flatten().dictionary_encode()
        self.words, self.n_rows = coded.dictionary, batch.num_rows
        self.ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.row = np.repeat(np.arange(batch.num_rows, dtype=np.int64), sizes)

    def buckets(self, high: int) -> Iterator[np.ndarray]:
        """For n = 1 to ``high`` the bucket of the n-gram at each place, inside one text or not."""
        sums = _checksums(self.words)[self.ids]
        folded = np.zeros(len(sums), np.uint64)
        for n in range(1, high + 1):
            m = len(sums) - n + 1
            if m <= 0:
                return
            folded = (folded[:m] ^ sums[n - 1 :]) * _MIX
            yield (folded >> _DOWN).astype(np.int64)

    def inside(self, n: int) -> np.ndarray:
        """Whether the n-gram at each place lies inside one text."""
        return self.row[: len(self.row) - n + 1] == self.row[n - 1 :]

    def grams(self, low: int, high: int, kept: np.ndarray | None) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Array]]:
        """For each n the rows and numbers of the n-grams, place by place, and the terms that the numbers mean."""
        n_words = max(len(self.words), 1)
        key, bound = self.ids, n_words
        held = self.buckets(high) if kept is not None else None
        for n in range(1, high + 1):
            m = len(self.ids) - n + 1
            if m <= 0:
                return
            if n > 1:
                if bound > (1 << 62) // n_words:
                    key = np.unique(key, return_inverse=True)[1]
                    bound = int(key.max()) + 1
                key, bound = key[:m] * n_words + self.ids[n - 1 :], bound * n_words
            wanted = self.inside(n)
            if held is not None:
                wanted &= kept[next(held)]
            if n < low:
                continue
            places = np.flatnonzero(wanted)
            _, first, gram = np.unique(key[places], return_index=True, return_inverse=True)
            parts = [self.words.take(pa.array(self.ids[places[first] + j])) for j in range(n)]
            yield self.row[places], gram, parts[0] if n == 1 else pc.binary_join_element_wise(*parts, " ")

    def counted(self, low: int, high: int, kept: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
        """``(row, gram, tf, terms)`` of all n-grams: each row's n-grams once, rows in order."""
        rows, grams, tfs, terms, seen = [], [], [], [], 0
        for row, gram, named in self.grams(low, high, kept):
            pairs, tf = np.unique(row * max(len(named), 1) + gram, return_counts=True)
            rows.append(pairs // max(len(named), 1))
            grams.append(pairs % max(len(named), 1) + seen)
            tfs.append(tf.astype(np.int64))
            terms.append(named.cast(pa.string()))
            seen += len(named)
        if not rows:
            empty = np.zeros(0, np.int64)
            return empty, empty, empty, pa.array([], pa.string())
        row, gram, tf, named = np.concatenate(rows), np.concatenate(grams), np.concatenate(tfs), pa.concat_arrays(terms)
        if low < high and pc.any(pc.match_substring(self.words, " ")).as_py():  # a word with a blank may equal a pair
            coded = named.dictionary_encode()
            same = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            pairs, at = np.unique(row * len(coded.dictionary) + same[gram], return_inverse=True)
            row, gram, named = pairs // len(coded.dictionary), pairs % len(coded.dictionary), coded.dictionary
            tf = np.bincount(at, weights=tf).astype(np.int64)
        order = np.argsort(row, kind="stable")
        return row[order], gram[order], tf[order], named


def _held(kept: bytes | None) -> np.ndarray | None:
    return None if kept is None else np.unpackbits(np.frombuffer(kept, np.uint8)).astype(bool)


def counts(lists: DataFrame, low: int, high: int, kept: bytes | None = None, arrays: bool = False) -> DataFrame:
    """``(key, term, tf)`` from ``(key, words)``, or with ``arrays`` one ``(key, counts)`` a row."""
    name = lists.columns[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = _held(kept)
        for batch in _chunks(batches):
            chunk = _Chunk(batch)
            row, gram, tf, named = chunk.counted(low, high, wanted)
            terms = named.take(pa.array(gram))
            if arrays:
                ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=chunk.n_rows))]).astype(np.int32)
                pairs = pa.StructArray.from_arrays([terms, pa.array(tf)], ["term", "tf"])
                columns = [batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pairs)]
                yield pa.RecordBatch.from_arrays(columns, [name, "counts"])
            else:
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), terms, pa.array(tf)], [name, "term", "tf"])

    more = [T.StructField("counts", T.ArrayType(T.StructType(_PAIR)))] if arrays else _PAIR
    return lists.mapInArrow(run, T.StructType([lists.schema[0], *more]))


def weights(lists: DataFrame, low: int, high: int, kept: bytes | None, terms: list[str], idf: list[float], sublinear: bool) -> DataFrame:
    """``(key, id, weight)``, the id being the place in ``terms``: weights of each row by itself, of length one together."""
    name, known, factor = lists.columns[0], pa.array(terms, pa.string()), np.array(idf, float)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = _held(kept)
        for batch in _chunks(batches):
            chunk = _Chunk(batch)
            row, gram, tf, named = chunk.counted(low, high, wanted)
            found = pc.fill_null(pc.index_in(named, value_set=known), -1).to_numpy(zero_copy_only=False)[gram]
            inside = found >= 0
            row, found, tf = row[inside], found[inside], tf[inside].astype(float)
            raw = (np.log(tf) + 1.0 if sublinear else tf) * factor[found]
            norm = np.sqrt(np.bincount(row, raw * raw, minlength=chunk.n_rows))
            columns = [batch.column(0).take(pa.array(row)), pa.array(found.astype(np.int32)), pa.array(raw / norm[row])]
            yield pa.RecordBatch.from_arrays(columns, [name, "_id", "weight"])

    more = [T.StructField("_id", T.IntegerType()), T.StructField("weight", T.DoubleType())]
    return lists.mapInArrow(run, T.StructType([lists.schema[0], *more]))


def totals(lists: DataFrame, low: int, high: int, kept: bytes | None = None) -> DataFrame:
    """``(term, cf, df)`` over all rows, summed by chunk before anything is moved."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = _held(kept)
        for batch in _chunks(batches):
            _, gram, tf, named = _Chunk(batch).counted(low, high, wanted)
            cf = np.bincount(gram, weights=tf, minlength=len(named)).astype(np.int64)
            df = np.bincount(gram, minlength=len(named)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([named, pa.array(cf), pa.array(df)], ["term", "cf", "df"])

    parts = lists.select(WORDS).mapInArrow(run, "term string, cf bigint, df bigint")
    return parts.groupBy("term").agg(F.sum("cf").alias("cf"), F.sum("df").alias("df"))


def bucket_sums(lists: DataFrame, low: int, high: int) -> DataFrame:
    """``(bucket, n)``: the occurrences of all n-grams of a bucket, summed by task before they are moved."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(BUCKETS, np.int64)
        for batch in _chunks(batches):
            chunk = _Chunk(batch)
            for n, held in enumerate(chunk.buckets(high), 1):
                if n >= low:
                    sums += np.bincount(held[chunk.inside(n)], minlength=BUCKETS)
        found = np.flatnonzero(sums)
        for at in range(0, len(found), 1 << 16):
            part = found[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(sums[part])], ["bucket", "n"])

    return lists.select(WORDS).mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
