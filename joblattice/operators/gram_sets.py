"""Sets of trigrams dealt to buckets and met with many queries inside tasks, as arrays.

A text's set stands in one row for each bucket that holds some of it, not in one row a trigram. To meet them, the
trigrams of the queries are numbered, the rows of a text are brought together, and what each text shares with each query
is counted by numbers; no row a trigram, or a trigram and query, leaves a task.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks bring this code along; workers need no copy of the package

#: Texts times queries, and meetings of trigrams, that are counted at once in a task.
CELLS, MEETINGS = 1 << 19, 1 << 20
#: Texts whose words are numbered at once, and texts times trigrams that are marked at once.
TEXTS, FLAGS = 2048, 1 << 21
_ROUNDING = 1e-9


def _kind(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def bucket_of(gram: Column, buckets: int) -> Column:
    return F.pmod(F.crc32(gram.cast("binary")), F.lit(buckets)).cast("int")


def _of_word(word: str) -> list[str]:
    """As ``functions.trigram``, whose pattern also starts between the two halves of a letter beyond 16 bits."""
    p = f"  {word} "
    return [p[i : i + 3] for i in range(len(word) + 1)] + [f"?{p[i + 1 : i + 3]}" for i, c in enumerate(p) if c > "\uffff" and p[i + 1] != " "]


def _bucketed(words: list[str], buckets: int) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """The trigrams of some words in the order of their buckets, these buckets, and the trigrams of each word by place and start."""
    places: dict[str, int] = {}
    of = [[places.setdefault(g, len(places)) for g in _of_word(w)] for w in words]
    home = np.fromiter((zlib.crc32(g.encode()) % buckets for g in places), np.int64, len(places))
    order = np.argsort(home, kind="stable")
    rank = np.empty(len(places), np.int64)
    rank[order] = np.arange(len(places))
    names = list(places)
    starts = np.cumsum([0, *map(len, of)])
    return [names[i] for i in order.tolist()], home[order], rank[np.fromiter(chain.from_iterable(of), np.int64, int(starts[-1]))], starts


def by_bucket(texts: DataFrame, key: str, buckets: int) -> DataFrame:
    """``(key, size, bucket, grams)`` of ``texts(key, words)``: a row for each bucket that holds some of a text's
    trigrams, size that of the whole set. Trigrams are made once for each word of a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, TEXTS) for b in batches for i in range(0, b.num_rows, TEXTS)):
            lengths = pc.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int64)
            tokens = batch.column(1).flatten().dictionary_encode()
            names, home, of, starts = _bucketed(tokens.dictionary.to_pylist(), buckets)
            words, ends, width = tokens.indices.to_numpy(zero_copy_only=False), np.cumsum(np.concatenate(([0], lengths))), len(names)
            known = pa.array(names, pa.string())
            step = max(1, FLAGS // max(1, width))
            for at in range(0, len(lengths) if width else 0, step):
                to = min(at + step, len(lengths))
                held = words[ends[at] : ends[to]]
                has = starts[held + 1] - starts[held]
                place = np.arange(int(has.sum())) + np.repeat(starts[held] - (np.cumsum(has) - has), has)
                flags = np.zeros((to - at) * width, bool)
                flags[np.repeat(np.repeat(np.arange(to - at) * width, lengths[at:to]), has) + of[place]] = True
                found = np.flatnonzero(flags)
                text, gram = found // width, found % width
                code = text * buckets + home[gram]
                firsts = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1]))) if len(code) else found
                sizes = np.bincount(text, minlength=to - at)
                grams = pa.ListArray.from_arrays(pa.array(np.concatenate((firsts, [len(code)])), pa.int32()), known.take(pa.array(gram)))
                numbers = (pa.array(a, pa.int32()) for a in (sizes[text[firsts]], home[gram[firsts]]))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at + text[firsts])), *numbers, grams], [key, "size", "bucket", "grams"])

    schema = f"`{key}` {_kind(texts, key)}, size int, bucket int, grams array<string>"
    return texts.select(F.col(key), "words").mapInArrow(run, schema)


class Asked:
    """The trigrams of all queries by number, and for each the queries that have it."""

    def __init__(self, rows: list):
        """``rows`` of (query_id, query_size, gram)."""
        queries: dict = {}
        grams: dict = {}
        pairs = [(grams.setdefault(g, len(grams)), queries.setdefault((q, n), len(queries))) for q, n, g in rows]
        self.grams, self.ids = list(grams), [q for q, _ in queries]
        self.sizes = np.array([n for _, n in queries], np.int64)
        of = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        self.queries = of[:, 1].copy()
        self.starts = np.searchsorted(of[:, 0], np.arange(len(grams) + 1))

    def counts(self, texts: np.ndarray, grams: np.ndarray, n: int) -> np.ndarray:
        """(``n`` texts, queries): how many of the trigrams, each beside the number of its text, a query has."""
        has = self.starts[grams + 1] - self.starts[grams]
        total, width = int(has.sum()), len(self.ids)
        place = np.arange(total) + np.repeat(self.starts[grams] - (np.cumsum(has) - has), has)
        return np.bincount(np.repeat(texts * width, has) + self.queries[place], minlength=n * width).reshape(n, width)


def numbered(sets: DataFrame, key: str, asked: Asked) -> DataFrame:
    """``(key, size, grams)`` of ``sets`` with the numbers of the trigrams asked for; rows without any are left out."""
    held = sets.sparkSession.sparkContext.broadcast(asked.grams)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(held.value, pa.string())
        for batch in batches:
            lengths = pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False).astype(np.int64)
            found = pc.index_in(batch.column(2).flatten().cast(pa.string()), value_set=known)
            rows = np.repeat(np.arange(len(lengths)), lengths)[pc.is_valid(found).to_numpy(zero_copy_only=False)]
            left = np.bincount(rows, minlength=len(lengths))
            some = np.flatnonzero(left)
            ends = pa.array(np.concatenate(([0], np.cumsum(left[some]))), pa.int32())
            grams = pa.ListArray.from_arrays(ends, found.drop_null())
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(some)) for c in (0, 1)), grams], [key, "size", "grams"])

    slim = sets.select(F.col(key), "size", "grams")
    return slim.mapInArrow(run, f"`{key}` {_kind(sets, key)}, size int, grams array<int>")


def _texts(batch: pa.RecordBatch, last: tuple | None) -> tuple[np.ndarray, bool]:
    """The number within the batch of each row's text (rows of one key and size), and whether the first one is ``last``."""
    keys = batch.column(0).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    sizes = batch.column(1).to_numpy(zero_copy_only=False)
    new = (keys[1:] != keys[:-1]) | (sizes[1:] != sizes[:-1])
    return np.concatenate(([0], np.cumsum(new))), last == (batch.column(0)[0].as_py(), int(sizes[0]))


def shared(sets: DataFrame, key: str, asked: Asked, query_kind: T.DataType, threshold: float, top_n: int | None) -> DataFrame:
    """``(query_id, key, size, query_size, common)`` of the numbered ``sets`` whose rows lie by key and size.

    Pairs that miss the threshold are left out, and with ``top_n`` those that have so many better ones among the
    texts counted beside them; the rest may still hold some of either.
    """
    held = sets.sparkSession.sparkContext.broadcast(asked)
    id_type = to_arrow_type(query_kind)
    schema = f"query_id {query_kind.simpleString()}, `{key}` {_kind(sets, key)}, size int, query_size int, common bigint"

    def near(keys: pa.Array, sizes: np.ndarray, common: np.ndarray) -> pa.RecordBatch:
        a, either = held.value, sizes[:, None] + held.value.sizes[None, :] - common
        less, more = np.minimum(sizes[:, None], a.sizes[None, :]), np.maximum(sizes[:, None], a.sizes[None, :])
        fits = (common > 0) & (less >= more * threshold - _ROUNDING)
        odd = fits & (either <= 0)  # keys that repeat
        score = np.where(fits & ~odd, common / np.where(either > 0, either, 1), -1.0)
        fits &= odd | (score >= threshold - _ROUNDING)
        if top_n is not None and len(sizes) > top_n:
            fits &= odd | (score >= np.partition(score, len(sizes) - top_n, axis=0)[len(sizes) - top_n])
        text, query = np.nonzero(fits)
        columns = [pa.array(a.ids, id_type).take(pa.array(query)), keys.take(pa.array(text))]
        columns += [pa.array(sizes[text], pa.int32()), pa.array(a.sizes[query], pa.int32()), pa.array(common[text, query], pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["query_id", key, "size", "query_size", "common"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, last, open_ = held.value, None, None  # the text at the end of a batch may go on in the next one
        for batch in batches:
            if not batch.num_rows:
                continue
            texts, goes_on = _texts(batch, last)
            firsts = np.flatnonzero(np.concatenate(([True], texts[1:] != texts[:-1])))
            keys = batch.column(0).take(pa.array(firsts))
            sizes = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)[firsts]
            lengths = pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False).astype(np.int64)
            grams = batch.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            of = np.repeat(texts, lengths)
            if open_ is not None and not goes_on:
                yield near(*open_)
            before = open_[2] if goes_on else 0
            met = np.cumsum(np.concatenate(([0], a.starts[grams + 1] - a.starts[grams])))
            ends = met[np.searchsorted(of, np.arange(1, len(sizes) + 1))]
            at, done = 0, 0
            while at < len(sizes):
                to = int(np.searchsorted(ends, done + MEETINGS, side="right"))
                to = min(max(to, at + 1), at + max(1, CELLS // max(1, len(a.ids))), len(sizes))
                low, high = np.searchsorted(of, (at, to))
                common = a.counts(of[low:high] - at, grams[low:high], to - at)
                if at == 0:
                    common[0] += before[0] if goes_on else 0
                full = to - at if to < len(sizes) else to - at - 1
                if full:
                    yield near(keys[at : at + full], sizes[at : at + full], common[:full])
                if to == len(sizes):
                    open_ = keys[to - 1 : to], sizes[to - 1 : to], common[-1:].copy()
                at, done = to, int(ends[to - 1])
            last = (batch.column(0)[batch.num_rows - 1].as_py(), int(sizes[-1]))
        if open_ is not None:
            yield near(*open_)

    return sets.mapInArrow(run, schema)
