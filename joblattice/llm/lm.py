"""Text probability by online logistic mixing of hashed-context bit predictors.

A text is its lower-cased words and one end. Tokens are written in a Huffman code over a bounded table of
frequent words, the end and an escape for all other words. Every bit of a code is predicted by
several models: the code's own statistics, counts under hashes of the last one and the last two
tokens, and a constant. Their predictions are mixed in the logistic domain by weights that a gate
selects (how much the contexts have seen), the weights learn from every bit of a text from its first
to its last, and an adaptive table refines the mixed prediction. A word behind the escape has the probability of its training
count, mixed with that of its spelling, which other hashed-context bit predictors give byte by byte.

Two parts adapt to what a text repeats. Where its last three tokens have stood in it before, a flag,
whose chance adapts to the flags of the text, says whether the next token is as it was then. Words
behind the escape come from an urn, to which each drawn word goes back with a copy. Either part is
mixed half and half, text by text, with the same text scored without it.

Spark counts the words and the context tables over all training documents; weights start from the mean
of what they become over the tuning fold, training documents that the context tables leave out until then.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from joblattice.llm.shared import as_bytes, crc_remainder, discard, sharded, staged

FOLDS, HELD_OUT, TUNING = 7, 2, 3


@dataclass(frozen=True)
class Spec:
    """``max_frequent`` words of at most ``max_bytes`` bytes make the table that tasks hold in memory.

    ``code_bits`` bounds the bits of a code that are modelled; by default all are. Tasks take texts of about
    ``block_tokens`` tokens at a time, for mixing ``mixed_tokens``, so that there are enough to go side by side.
    """

    max_frequent: int = 131_072
    max_bytes: int = 40
    code_bits: int | None = None
    table_bits: int = 20
    spell_bits: int = 18
    block_tokens: int = 200_000
    mixed_tokens: int = 3_000_000
    rate: float = 0.01
    urn: float = 32.0
    tuning_rate: float = 0.03
    refine: float = 0.02


_ODD = np.uint64(0x9E3779B97F4A7C15)
_GATES, _INPUTS, _BUCKETS = 9, 4, 33
#: What the constant input says, and the number of texts below which each is gone through by itself.
_BIAS, _NARROW = 0.3, 24
#: Texts that are gone through side by side, and their bits that are looked up at a time.
_LANES, _WINDOW = 1024, 64
#: Tokens whose bits are looked up at a time for counting.
_PIECE = 5_000
#: Tokens whose scores are put together at a time.
_SCORED = 200_000
_CHUNK = 1 << 14
#: Bytes back that the spelling models look.
ORDERS = 4
#: What a spelling model's prediction weighs, by its order and by how much its context has seen.
TRUST = np.array([[0, 1.4**k, 3 * 1.4**k] for k in range(ORDERS)], np.float32)
SHARPEN = 1.2
#: Hits and misses that the flags of a text are taken to have had: after none or a miss, after a hit.
FLAGS = ((0.1, 2.0), (2.0, 0.2))


def _hash(*parts: np.ndarray) -> np.ndarray:
    out = np.zeros(len(parts[0]), np.uint64)
    for p in parts:
        out = (out ^ p.astype(np.uint64)) * _ODD
        out ^= out >> np.uint64(29)
    return out


def _stretched(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(stretch of the chance of a one, how much was seen: 0, 1 or 2) of counts[0] zeros and counts[1] ones."""
    zeros, ones = counts.astype(np.float64)
    seen = zeros + ones
    return np.log((ones + 0.4) / (zeros + 0.4)).astype(np.float32), ((seen > 0).astype(np.int8) + (seen > 30))


# --- word counts -----------------------------------------------------------------------------------


def count_words(docs: DataFrame) -> DataFrame:
    """(word, c): every word of any document with its count over the training documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flush() -> pa.RecordBatch:
            rows = [pa.array(list(counts.keys()), pa.binary()), pa.array(list(counts.values()), pa.int64())]
            counts.clear()
            return pa.RecordBatch.from_arrays(rows, ["word", "c"])

        for batch in batches:
            for text, held in zip(as_bytes(batch.column(1)), batch.column(2).to_pylist()):
                words = text.lower().split()
                if held:
                    for w in words:
                        counts.setdefault(w, 0)
                else:
                    counts.update(words)
                if len(counts) > 400_000:
                    yield flush()
        yield flush()

    return docs.mapInArrow(run, "word binary, c bigint").groupBy("word").agg(F.sum("c").alias("c"))


def frequent_words(vocabulary: DataFrame, spec: Spec) -> list[tuple[bytes, int]]:
    """The words above the count at which they would become more than ``max_frequent``, most frequent first."""
    short = vocabulary.where((F.col("c") > 1) & (F.length("word") <= spec.max_bytes))
    level = F.floor(F.log2("c") * 64)  # at most 64 levels for each power of two
    bar, total = -1, 0
    for at, n in sorted(map(tuple, short.groupBy(level.alias("level")).count().collect()), reverse=True):
        total += n
        if total > spec.max_frequent:
            bar = at
            break
    top = short.where(level > bar).select("word", "c").collect()  # at most max_frequent words of max_bytes
    return sorted(((bytes(w), int(c)) for w, c in top), key=lambda r: (-r[1], r[0]))


# --- the code --------------------------------------------------------------------------------------


class Code:
    """Huffman codes of the frequent words, the end and the escape; ``bits`` bounds the modelled bits of each."""

    def __init__(self, words: list[bytes], counts: list[int], ends: int, others: int, bits: int | None = None):
        self.index = {w: i for i, w in enumerate(words)}
        self.end, self.escape = len(words), len(words) + 1
        weight = [float(c) + 1.0 for c in (*counts, ends, others)]
        left, right = [-1] * len(weight), [-1] * len(weight)
        heap = [(w, i) for i, w in enumerate(weight)]
        heapq.heapify(heap)
        while len(heap) > 1:
            (a, i), (b, j) = heapq.heappop(heap), heapq.heappop(heap)
            left.append(i)
            right.append(j)
            weight.append(a + b)
            heapq.heappush(heap, (a + b, len(weight) - 1))
        n = len(words) + 2
        self.length = np.zeros(n, np.int64)  # modelled bits of each symbol
        self.tail = np.zeros(n)  # log10 of what bits beyond the bound have by the counts alone
        chance: list[float] = []  # of a one at each node that is modelled, numbered as they are met
        paths: list[tuple] = [()] * n
        todo = [(heap[0][1], 0, 0.0, ())]
        while todo:
            at, depth, tail, path = todo.pop()
            if left[at] < 0:
                self.length[at] = len(path)
                self.tail[at] = tail
                paths[at] = path
                continue
            one = weight[right[at]] / weight[at]
            modelled = bits is None or depth < bits
            number = len(chance)
            if modelled:
                chance.append(one)
            for child, b, p in ((left[at], 0, 1 - one), (right[at], 1, one)):
                if modelled:
                    todo.append((child, depth + 1, 0.0, (*path, (number, b))))
                else:
                    todo.append((child, depth + 1, tail + math.log10(p), path))
        # all ways one after the other: numbers of the nodes, and the bits taken there
        self.first = np.cumsum(self.length) - self.length
        self.node = np.array([v for path in paths for v, _ in path], np.int32)
        self.bit = np.array([b for path in paths for _, b in path], np.int8)
        self.chance = np.array(chance)
        self.own = np.log(self.chance / (1 - self.chance)).astype(np.float32)
        self._spread()

    def _spread(self) -> None:
        """What each node says along all ways, so that a bit takes one step to it."""
        self.own_at = self.own[self.node]
        self.mark_at = _hash(np.arange(len(self.chance)) + 1)[self.node]

    def __getstate__(self) -> dict:
        # tasks make the long arrays again: a broadcast lies on the disk of every executor
        return {k: v for k, v in self.__dict__.items() if k not in ("own_at", "mark_at")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._spread()


@dataclass
class Block:
    """The tokens of some texts: ``sym`` with an end after each text, where each text starts."""

    sym: np.ndarray
    starts: np.ndarray
    rare: list[Counter]

    @property
    def text(self) -> np.ndarray:
        """The number of the text of each token."""
        return np.repeat(np.arange(len(self.starts)), self.sizes)

    @property
    def sizes(self) -> np.ndarray:
        """The number of tokens of each text."""
        return np.diff(np.append(self.starts, len(self.sym)))

    def pieces(self, tokens: int) -> Iterator[tuple[int, int, slice, Block]]:
        """(first text, text behind the last, their tokens, a block of them), of at most ``tokens`` or of one longer text."""
        for a, b in sharded(self.sizes, tokens):
            low = int(self.starts[a])
            own = slice(low, int(self.starts[b]) if b < len(self.starts) else len(self.sym))
            yield a, b, own, Block(self.sym[own], self.starts[a:b] - low, self.rare[a:b])


def tokens_of(texts: list[bytes], code: Code, keep_rare: bool) -> Block:
    parts, rare = [], []
    get, escape, end = code.index.get, code.escape, np.array([code.end], np.int32)
    for text in texts:
        words = text.lower().split()
        found = np.fromiter(map(get, words, repeat(escape)), np.int32, len(words))
        parts += (found, end)
        if keep_rare:
            rare.append(Counter([words[i] for i in np.flatnonzero(found == escape).tolist()]))
    lengths = np.array([len(p) for p in parts[::2]], np.int64) + 1
    return Block(np.concatenate(parts), np.cumsum(lengths) - lengths, rare)


@dataclass
class Events:
    """One row per modelled bit, in the order of the texts."""

    token: np.ndarray
    node: np.ndarray
    bit: np.ndarray
    slots: tuple[np.ndarray, np.ndarray]


def contexts_of(sym: np.ndarray, starts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The last token and the one before it, of each token; before a text there are ends."""
    last, before = np.empty_like(sym), np.empty_like(sym)
    last[0:1], last[1:] = end, sym[:-1]
    before[:2], before[2:] = end, sym[:-2]
    before[starts] = end
    return last, before


def _ways(first: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(token, place among the ways of the code) of each bit, for tokens of which ``length`` bits from ``first`` are wanted."""
    token = np.repeat(np.arange(len(length), dtype=np.int32), length)
    at = (first - (np.cumsum(length) - length))[token]
    at += np.arange(len(at))
    return token, at


def _slots(context: np.ndarray, token: np.ndarray, mark: np.ndarray, bits: int) -> np.ndarray:
    slots = context.take(token)
    slots ^= mark
    slots *= _ODD
    slots >>= np.uint64(64 - bits)
    return slots.view(np.int64)


def events_of(block: Block, code: Code, spec: Spec) -> Events:
    sym = block.sym
    last, before = contexts_of(sym, block.starts, code.end)
    token, at = _ways(code.first[sym], code.length[sym])
    mark = code.mark_at.take(at)
    slots = tuple(_slots(c, token, mark, spec.table_bits) for c in (_hash(last + 1), _hash(last + 1, before + 7)))
    return Events(token, code.node.take(at), code.bit.take(at), slots)


# --- count tables ----------------------------------------------------------------------------------


_CELLS = "name int, chunk int, places binary, counts binary"


def _packed(table: np.ndarray, name: int) -> pa.RecordBatch:
    """A table of counts as rows of (table, chunk, places of the counts above 0, the counts in as few bytes as they need)."""
    rows = []
    for at in range(0, table.shape[1], _CHUNK):
        part = table[:, at : at + _CHUNK].ravel()
        places = np.flatnonzero(part)
        if len(places):
            counts = part[places]
            kind = np.min_scalar_type(counts.max()).newbyteorder("<")
            rows.append((name, at // _CHUNK, places.astype("<u2").tobytes(), counts.astype(kind).tobytes()))
    kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["name", "chunk", "places", "counts"]
    )


def _unpacked(places: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    at = np.frombuffer(places, "<u2")
    return at, np.frombuffer(counts, f"<u{len(counts) // len(at)}").astype(np.int64)


def add_tables(parts: DataFrame, sizes: dict[int, int]) -> dict[int, np.ndarray]:
    """The sums of all parts of each table. Chunks are dealt by number and added as they stream by."""
    width = {n: min(size, _CHUNK) for n, size in sizes.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for name, chunk, places, counts in zip(*(c.to_pylist() for c in batch.columns)):
                if (name, chunk) not in sums:
                    sums[name, chunk] = np.zeros((2, width[name]), np.int64)
                at, n = _unpacked(places, counts)
                sums[name, chunk].ravel()[at] += n  # places of one row differ
        for (name, chunk), v in sums.items():
            np.minimum(v, (1 << 31) - 1, out=v)
            row = _packed(v, name)
            yield row.set_column(1, "chunk", pa.array([chunk], pa.int32()))

    out = {n: np.zeros((2, size), np.int32) for n, size in sizes.items()}
    summed = staged(parts.repartition("name", "chunk").mapInArrow(run, _CELLS), "lm-tables")  # drops its shuffle files
    for name, chunk, places, counts in summed.toLocalIterator():
        at, n = _unpacked(places, counts)
        part = np.zeros(2 * width[name], np.int32)
        part[at] = n
        out[name][:, chunk * _CHUNK : chunk * _CHUNK + width[name]] = part.reshape(2, -1)
    discard(summed)
    return out


def add_counts(table: np.ndarray, more: np.ndarray) -> None:
    """Add counts in place, up to the largest number a table holds."""
    np.minimum(table, np.iinfo(np.int32).max - more, out=table)
    table += more


def _tally(slots: np.ndarray, bits: np.ndarray, table: np.ndarray) -> None:
    size = table.shape[1]
    table += np.bincount(slots + size * bits.astype(np.int64), minlength=2 * size).reshape(2, size).astype(table.dtype)


def few_tables(docs: DataFrame) -> DataFrame:
    """The rows in no more tasks than some for each core: every task sends tables of its own."""
    return docs.coalesce(max(4 * docs.sparkSession.sparkContext.defaultParallelism, 1))


def _cells(block: Block, code: Code, spec: Spec) -> np.ndarray:
    """For each context (a row), the cell of its table that each bit of the texts adds to."""
    last, before = contexts_of(block.sym, block.starts, code.end)
    length = code.length.take(block.sym)
    out, done = np.empty((2, int(length.sum())), np.int64), 0
    for a in range(0, len(length), _PIECE):  # pieces that stay in the processor's cache
        piece = slice(a, a + _PIECE)
        token, at = _ways(code.first.take(block.sym[piece]), length[piece])
        mark, ones = code.mark_at.take(at), code.bit.take(at).astype(np.int64)
        ones <<= spec.table_bits
        one = last[piece] + 1
        for k, context in enumerate((_hash(one), _hash(one, before[piece] + 7))):
            np.bitwise_or(_slots(context, token, mark, spec.table_bits), ones, out=out[k, done : done + len(at)])
        done += len(at)
    return out


def context_tables(docs: DataFrame, code: Code, spec: Spec) -> dict[int, np.ndarray]:
    held = docs.sparkSession.sparkContext.broadcast(code)  # bounded by the spec

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [np.zeros((2, 1 << spec.table_bits), np.int32) for _ in range(2)]
        for texts in _texts(batches, spec.block_tokens):
            for table, cells in zip(tables, _cells(tokens_of(texts, held.value, False), held.value, spec)):
                table += np.bincount(cells, minlength=table.size).reshape(table.shape).astype(table.dtype)
        for name, table in enumerate(tables):
            yield _packed(table, name)

    parts = few_tables(docs.select("rid", "text")).mapInArrow(run, _CELLS)
    found = add_tables(parts, {0: 1 << spec.table_bits, 1: 1 << spec.table_bits})
    held.destroy()
    return found


def _byte_lengths(texts: pa.Array) -> np.ndarray:
    lengths = pc.fill_null(pc.binary_length(texts.cast(pa.binary())), 0)
    return lengths.to_numpy(zero_copy_only=False).astype(np.int64)


def _texts(batches: Iterator[pa.RecordBatch], tokens: int) -> Iterator[list[bytes]]:
    """Texts of bounded size together, a very long one alone."""
    for batch in batches:
        for a, b in sharded(_byte_lengths(batch.column(1)) // 5 + 1, tokens):
            yield as_bytes(batch.column(1).slice(a, b - a))


# --- mixing ----------------------------------------------------------------------------------------


@dataclass
class Mixer:
    """Everything a task needs to predict code bits."""

    code: Code
    spec: Spec
    stretch: tuple[np.ndarray, np.ndarray]
    seen: tuple[np.ndarray, np.ndarray]
    weights: np.ndarray  # gates x inputs

    def __post_init__(self):
        # one look at a context gives both: the stretch as the lower half, the share in the gate as the upper
        self.both = []
        for stretch, seen, factor in zip(self.stretch, self.seen, (3, 1)):
            both = np.empty((len(stretch), 2), "<i4")
            both[:, 0], both[:, 1] = stretch.astype("<f4").view("<i4"), seen.astype("<i4") * factor
            self.both.append(both.view("<i8")[:, 0])

    def __reduce__(self):  # tasks put the halves together again
        return _joined, (self.code, self.spec, self.stretch, self.seen, self.weights)

    def run(self, block: Block, rate: float) -> tuple[np.ndarray, np.ndarray, int]:
        """(log10 probability of each token's code, sum of the texts' last weights, number of texts).

        Texts are predicted side by side, one bit of each in one step; the longest go first, and where
        a text has ended the next one takes its place. The last few are gone through one after the
        other. A text starts from the common weights and learns from all of its own bits and no
        others, so results don't depend on which texts a task happens to hold.
        """
        code, spec = self.code, self.spec
        n, starts = len(block.sym), block.starts
        # what is held for each token is few bytes: two ends before the texts, and ends behind them, for windows that reach over
        sym = np.full(n + 2 + _WINDOW, code.end, block.sym.dtype)
        sym[2 : n + 2] = block.sym
        length = code.length.astype(np.int16)
        upto = length.take(sym[2:])
        upto = np.cumsum(upto, dtype=np.int32 if upto.sum(dtype=np.int64) < 1 << 30 else np.int64)
        stop = np.append(starts[1:], n)
        begin = upto[starts].astype(np.int64) - length[block.sym[starts]]
        size = upto[stop - 1] - begin
        # the token at the first bit of each window of each text, and at the bit behind its last one
        count = -(-size // _WINDOW) + 1
        first = np.cumsum(count) - count
        bound = np.repeat(begin - first * _WINDOW, count) + np.arange(count.sum()) * _WINDOW
        bound = np.minimum(bound, upto[-1] - 1)
        known = Known(sym, upto, bound, _behind(upto, bound))
        logs = np.zeros(n)
        queue = np.argsort(-size, kind="stable")
        queue = queue[: np.count_nonzero(size)]
        fresh = self.weights.astype(np.float64)
        total = fresh * (len(size) - len(queue))
        centre = (np.arange(_BUCKETS) - _BUCKETS // 2) / 2
        flat = 1 / (1 + np.exp(-centre))
        text, queue = queue[:_LANES], queue[_LANES:]
        done = np.zeros(len(text), np.int64)  # windows
        weights, table = np.repeat(fresh[None], len(text), axis=0), np.repeat(flat[None], len(text), axis=0)
        while len(text):
            many, left = len(text), size[text] - done * _WINDOW
            tokens, lows, token, inputs, gate, bit = self._window(known, first[text] + done, starts[text])
            ended = np.flatnonzero(left <= _WINDOW)
            for i in ended.tolist():  # bits behind the end of a text change nothing
                inputs[left[i] :, i] = 0
            step = _steps if many >= _NARROW else _one_by_one
            chance = step(inputs, gate, bit, weights, table, rate, spec.refine)
            chance *= bit - 0.5
            chance += 1 - bit
            chance = np.log(np.maximum(chance, 1e-6, out=chance).T.copy())
            for i in ended.tolist():
                chance[i, left[i] :] = 0
            own = tokens < np.repeat(stop[text], np.diff(lows))
            logs[tokens[own]] += np.bincount(token, chance.ravel(), minlength=len(tokens))[own]
            done += 1
            if not len(ended):
                continue
            total += weights[ended].sum(axis=0)
            more = min(len(ended), len(queue))
            text[ended[:more]], queue = queue[:more], queue[more:]
            done[ended[:more]], weights[ended[:more]], table[ended[:more]] = 0, fresh, flat
            if more < len(ended):
                kept = np.ones(many, bool)
                kept[ended[more:]] = False
                text, done, weights, table = text[kept], done[kept], weights[kept], table[kept]
        logs /= math.log(10)
        if code.tail.any():
            logs += code.tail[block.sym]
        return logs, total, len(size)

    def _window(self, known: Known, window: np.ndarray, begins: np.ndarray) -> tuple:
        """What the bits of one window of each text are predicted from.

        (tokens, first of each text among them, token of each bit, inputs, gates with the number of
        the text, bits), the last three with a row for each step.
        """
        many, code, spec, sym, upto = len(window), self.code, self.spec, known.sym, known.upto
        bits, low, after = known.bound[window], known.at[window], known.at[window + 1]
        from_bit = lambda at: upto[at] - code.length[sym[at + 2]]
        high = after + (from_bit(after) < bits + _WINDOW)
        short = np.flatnonzero(known.bound[window + 1] != bits + _WINDOW)  # behind the last text
        high[short] = _behind(upto, bits[short] + (_WINDOW - 1)) + 1
        starts = np.zeros(many + 1, np.int64)
        np.cumsum(high - low, out=starts[1:])
        tokens = np.arange(starts[-1]) + np.repeat(low - starts[:-1], high - low)
        symbols, last, before = sym.take(tokens + 2), sym.take(tokens + 1), sym.take(tokens)
        before[starts[:-1][low == begins]] = code.end  # the text before ends one token earlier
        way, wanted = code.first.take(symbols), code.length.take(symbols)
        skipped = bits - from_bit(low)
        way[starts[:-1]] += skipped
        wanted[starts[:-1]] -= skipped
        wanted[starts[1:] - 1] -= upto[high - 1] - (bits + _WINDOW)
        token, at = _ways(way, wanted)
        mark = code.mark_at.take(at)
        rows = lambda v: v.reshape(many, _WINDOW).T
        inputs = np.empty((_WINDOW, many, _INPUTS), np.float32)
        inputs[:, :, 0] = rows(code.own_at.take(at))
        inputs[:, :, 3] = _BIAS
        gate = 0
        last += 1
        for k, context in enumerate((_hash(last), _hash(last, before + 7))):
            both = self.both[k].take(_slots(context, token, mark, spec.table_bits))
            inputs[:, :, 1 + k] = rows(both.view("<f4")[::2])
            both >>= 32
            gate += both
        gate = rows(gate) + np.arange(many) * _GATES
        return tokens, starts, token, inputs, gate, rows(code.bit.take(at)).astype(float, order="C")


@dataclass
class Known:
    """Of each token its symbol, behind two ends, and the bits of all codes up to it; of each window its first bit and the token there."""

    sym: np.ndarray
    upto: np.ndarray
    bound: np.ndarray
    at: np.ndarray


def _behind(upto: np.ndarray, bits: np.ndarray) -> np.ndarray:
    return np.searchsorted(upto, bits.astype(upto.dtype), side="right")  # other kinds would be copied whole


def _joined(*parts) -> Mixer:
    """A mixer for tasks, which look at contexts as a whole only."""
    mixer = Mixer(*parts)
    mixer.stretch = mixer.seen = ()
    return mixer


def _steps(inputs, gates, bits, weights, table, rate: float, refine: float) -> np.ndarray:
    """Sums of both chances of every bit; a row of bits is one step, which changes weights and tables in place."""
    chance = np.empty(bits.shape)
    rows = weights.reshape(-1, _INPUTS)
    whole = rows.view(f"V{8 * _INPUTS}")[:, 0]  # a text's weights are moved as one
    cells, base = table.reshape(-1), np.arange(bits.shape[1]) * _BUCKETS
    for x, y, at, out in zip(inputs, bits, gates, chance):
        x, w = x.astype(np.float64), rows.take(at, axis=0)
        z = np.einsum("ij,ij->i", x, w)
        np.minimum(np.maximum(z, -7.9, out=z), 7.9, out=z)
        p = np.exp(-z)
        p += 1
        np.divide(1, p, out=p)
        z *= 2
        z += 0.5 + _BUCKETS // 2
        cell = z.astype(np.int64)
        cell += base
        q = cells.take(cell)
        np.add(p, q, out=out)
        np.subtract(y, p, out=p)
        p *= rate
        x *= p[:, None]
        w += x
        whole[at] = w.view(whole.dtype)[:, 0]
        cells[cell] = q + refine * (y - q)
    return chance


def _one_by_one(inputs, gates, bits, weights, table, rate: float, refine: float) -> np.ndarray:
    """As ``_steps``, for so few texts that it is quicker to go through them one after the other."""
    chance = np.empty(bits.shape)
    for i in range(bits.shape[1]):
        chance[:, i], weights[i], table[i] = _alone(
            inputs[:, i], bits[:, i], gates[:, i] - i * _GATES, weights[i], table[i], rate, refine
        )
    return chance


def _alone(inputs, bits, gates, weights, table, rate: float, refine: float) -> tuple[list, list, list]:
    """``_steps`` for the bits of one text: (sums of both chances, weights, table)."""
    weights, table, out, half = weights.tolist(), table.tolist(), [], _BUCKETS // 2 + 0.5
    for (a, b, c, d), y, gate in zip(inputs.tolist(), bits.tolist(), gates.tolist()):
        w = weights[gate]
        wa, wb, wc, wd = w
        z = min(max(a * wa + b * wb + c * wc + d * wd, -7.9), 7.9)
        p = 1 / (1 + math.exp(-z))
        cell = int(2 * z + half)
        q = table[cell]
        out.append(p + q)
        step = rate * (y - p)
        weights[gate] = (wa + step * a, wb + step * b, wc + step * c, wd + step * d)
        table[cell] = q + refine * (y - q)
    return out, weights, table


def text_scores(block: Block, logs: np.ndarray, escape: int) -> np.ndarray:
    """log10 probability of each text from those of its tokens, with the flags for repeats mixed in.

    The token after the last earlier place of the same three tokens is foretold; the escape never is.
    The flags of a text are drawn from two urns of hits and misses, one for flags after a hit, so
    their probability follows from counts alone. Texts are gone through some at a time.
    """
    return np.concatenate([_text_scores(part, logs[own], escape) for _, _, own, part in block.pieces(_SCORED)])


def _text_scores(block: Block, logs: np.ndarray, escape: int) -> np.ndarray:
    plain = np.add.reduceat(logs, block.starts)
    sym, text, n = block.sym, block.text, len(block.sym)
    at = np.flatnonzero(np.arange(n) - block.starts[text] >= 3)
    if not len(at):
        return plain
    shift = np.uint64(n.bit_length())
    keys = _hash(text[at] + 1, sym[at - 1] + 1, sym[at - 2] + 1, sym[at - 3] + 1)
    keys = np.sort((keys >> shift << shift) | at.astype(np.uint64))
    same = np.flatnonzero((keys[1:] >> shift) == (keys[:-1] >> shift))
    places = (keys & ((np.uint64(1) << shift) - np.uint64(1))).astype(np.int64)
    now, then = places[same + 1], places[same]
    sure = (text[now] == text[then]) & (sym[then] != escape)
    for back in (1, 2, 3):
        sure &= sym[now - back] == sym[then - back]
    now, then = now[sure], then[sure]
    if not len(now):
        return plain
    order = np.argsort(now)
    now, then = now[order], then[order]
    owner, hit = text[now], sym[now] == sym[then]
    after = np.zeros(len(now), np.int64)
    after[1:] = hit[:-1] & (owner[1:] == owner[:-1])
    flags = np.bincount(owner * 4 + after * 2 + hit, minlength=4 * len(plain)).reshape(-1, 2, 2)
    told = plain - np.bincount(owner, logs[now] * hit, minlength=len(plain))
    for i in np.unique(owner).tolist():
        for (misses, hits), (a, b) in zip(flags[i].tolist(), FLAGS):
            told[i] += (_log_beta(hits + a, misses + b) - _log_beta(a, b)) / math.log(10)
    met = flags.any(axis=(1, 2))
    both = np.logaddexp(plain * math.log(10), told * math.log(10)) / math.log(10) - math.log10(2)
    return np.where(met, both, plain)


def _log_beta(a: float, b: float) -> float:
    return math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b)


def log_gamma(x: Column) -> Column:
    """Natural logarithm of the gamma function of a positive column, by Stirling's series eight steps on."""
    y, steps = x + 8, x
    for j in range(1, 8):
        steps = steps * (x + j)
    series = 1 / (12 * y) - 1 / (360 * F.pow(y, F.lit(3.0))) + 1 / (1260 * F.pow(y, F.lit(5.0)))
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - F.log(steps)


def log_rising(a: Column, n: Column) -> Column:
    """log10 of a (a + 1) ... (a + n - 1)."""
    return (log_gamma(a + n) - log_gamma(a)) / math.log(10)


def log_drawn(chance: Column, urn: float, n: Column) -> Column:
    """``log_rising`` of the urn's share of a word, whose chance is given by its log10 and may be below any double."""
    share = F.pow(F.lit(10.0), chance) * urn
    return chance + math.log10(urn) + log_rising(share + 1, n - 1)


def log_sum(a: Column, b: Column) -> Column:
    """log10 of the sum of two probabilities given by theirs."""
    high = F.greatest(a, b)
    return high + F.log10(1 + F.pow(F.lit(10.0), F.least(a, b) - high))


def log_mean(a: Column, b: Column) -> Column:
    """log10 of the mean of two probabilities given by theirs."""
    high = F.greatest(a, b)
    return high + F.log10(0.5 + 0.5 * F.pow(F.lit(10.0), F.least(a, b) - high))


def tune(docs: DataFrame, mixer: Mixer) -> np.ndarray:
    """The mean of the weights that the texts of ``docs`` end with; the given ones if there are none."""
    held, spec = docs.sparkSession.sparkContext.broadcast(mixer), mixer.spec

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((_GATES, _INPUTS)), 0
        for texts in _texts(batches, spec.mixed_tokens):
            _, weights, lanes = held.value.run(tokens_of(texts, held.value.code, False), spec.tuning_rate)
            total += weights
            n += lanes
        rows = [pa.array(range(total.size), pa.int32()), pa.array(total.ravel()), pa.array([n] * total.size, pa.int64())]
        yield pa.RecordBatch.from_arrays(rows, ["k", "w", "n"])

    found = docs.select("rid", "text").mapInArrow(run, "k int, w double, n bigint").groupBy("k")
    rows = found.agg(F.sum("w").alias("w"), F.sum("n").alias("n")).orderBy("k").collect()
    held.destroy()
    if not rows or not rows[0]["n"]:
        return mixer.weights
    return np.array([r["w"] / r["n"] for r in rows]).reshape(_GATES, _INPUTS)


# --- spelling --------------------------------------------------------------------------------------


def _spelled(words: list[bytes], spec: Spec) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(word, bit, slots of each order) of every bit of every byte; a blank ends a word."""
    data = np.frombuffer(b" ".join([*words, b""]), np.uint8)
    length = np.array([len(w) + 1 for w in words])
    word = np.repeat(np.arange(len(words), dtype=np.int32), length)
    place = np.arange(len(data)) - np.repeat(np.cumsum(length) - length, length)
    bits = np.unpackbits(data[:, None], axis=1)
    node = np.ones((len(data), 8), np.int32)
    for j in range(1, 8):
        node[:, j] = node[:, j - 1] * 2 + bits[:, j - 1]
    mark = _hash(np.arange(256) + 1)[node]
    slots = []
    shift = np.uint64(64 - spec.spell_bits)
    context = np.zeros(len(data), np.uint64)
    for order in range(ORDERS):
        earlier = np.zeros(len(data), np.uint64)
        earlier[order + 1 :] = data[: -order - 1]
        earlier[place <= order] = 0
        context = _hash(context, earlier + np.uint64(1 + order))
        slots.append((((context[:, None] ^ mark) * _ODD) >> shift).astype(np.int32).ravel())
    return np.repeat(word, 8), bits.ravel(), slots


@dataclass
class Speller:
    spec: Spec
    stretch: list[np.ndarray]
    seen: list[np.ndarray]

    def log10(self, words: list[bytes]) -> np.ndarray:
        out = np.zeros(len(words))
        for a, b in sharded(np.array([len(w) + 1 for w in words]), 200_000):
            word, bit, slots = _spelled(words[a:b], self.spec)
            # an order that has seen more counts for more
            total, weight = np.zeros(len(word), np.float32), np.full(len(word), 1e-6, np.float32)
            for order, slot in enumerate(slots):
                trust = TRUST[order, self.seen[order][slot]]
                total += trust * self.stretch[order][slot]
                weight += trust
            z = np.clip(SHARPEN * total / weight, -9, 9)
            p = 1 / (1 + np.exp(-np.where(bit > 0, z, -z)))
            out[a:b] = np.bincount(word, np.log10(p), minlength=b - a)
        return out


def spell_tables(vocabulary: DataFrame, spec: Spec) -> Speller:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [np.zeros((2, 1 << spec.spell_bits), np.int32) for _ in range(ORDERS)]
        for batch in batches:
            words = batch.column(0).to_pylist()
            for a, b in sharded(np.array([len(w) + 1 for w in words]), 200_000):
                _, bit, slots = _spelled(words[a:b], spec)
                for slot, table in zip(slots, tables):
                    _tally(slot, bit, table)
        for name, table in enumerate(tables):
            yield _packed(table, name)

    parts = few_tables(vocabulary.select("word")).mapInArrow(run, _CELLS)
    found = add_tables(parts, {k: 1 << spec.spell_bits for k in range(ORDERS)})
    both = [_stretched(found[k]) for k in range(ORDERS)]
    return Speller(spec, [s for s, _ in both], [n for _, n in both])


# --- the operator ----------------------------------------------------------------------------------


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", spec: Spec = Spec()) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    Training documents are those whose crc32 remainder by 7 is not 2. ``base_score`` is the smoothed
    unigram score, ``score`` the model's log10 probability of words and end, ``bits_per_byte`` the same
    in bits by the bytes of the text and its end. Null, empty and blank texts are the end alone. A null
    id counts as empty text for the remainder. Repeated rows count as often as they occur. Without
    training documents all counts are zero. Other columns are not looked at.
    """
    spark = docs.sparkSession
    remainder = crc_remainder(F.col(id_col), FOLDS)
    kind = docs.schema[id_col].dataType.simpleString()
    slim = docs.select(F.col(id_col).alias("rid"), F.col(text_col).alias("text"), remainder.alias("fold"))
    training, held_out = F.col("fold") != HELD_OUT, (F.col("fold") == HELD_OUT).alias("held")
    vocabulary = staged(count_words(slim.select("rid", "text", held_out)), "lm-words")
    n_words, n_types, once = vocabulary.agg(
        F.sum("c"), F.sum((F.col("c") > 0).cast("int")), F.sum((F.col("c") == 1).cast("int"))
    ).first()
    ends = slim.where(training).count()
    n_train, n_types = int(n_words or 0) + ends, int(n_types or 0) + (ends > 0)
    rows = frequent_words(vocabulary, spec)
    n_rare = n_train - ends - sum(c for _, c in rows)
    code = Code([w for w, _ in rows], [c for _, c in rows], ends, n_rare, spec.code_bits)
    tables = context_tables(slim.where(training & (F.col("fold") != TUNING)), code, spec)
    both = [_stretched(tables[k]) for k in range(2)]
    tuning = slim.where(F.col("fold") == TUNING)
    start = np.tile(np.array([0.3, 0.4, 0.4, 0.0]), (_GATES, 1))
    mixer = Mixer(code, spec, tuple(s for s, _ in both), tuple(n for _, n in both), start)
    mixer.weights = tune(tuning, mixer)
    # the weights are settled; scoring knows the contexts of all training documents
    for k, more in context_tables(tuning, code, spec).items():
        add_counts(tables[k], more)
    both = [_stretched(tables[k]) for k in range(2)]
    mixer = Mixer(code, spec, tuple(s for s, _ in both), tuple(n for _, n in both), mixer.weights)

    held = spark.sparkContext.broadcast(mixer)
    known = np.array([c for _, c in rows] + [ends, 0], np.int64)
    floor = math.log10(n_train + n_types + 1) if n_train + n_types else 0.0
    counted, base = (known > 0).astype(np.int64), np.log10(known + 1.0) - floor
    base[code.escape] = 0.0  # words behind it are counted below

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row = TaskContext.get().partitionId(), 0
        model = held.value
        for batch in batches:
            n_bytes = _byte_lengths(batch.column(1))
            for a, b in sharded(n_bytes // 5 + 1, spec.mixed_tokens):
                block = tokens_of(as_bytes(batch.column(1).slice(a, b - a)), model.code, True)
                logs, _, _ = model.run(block, spec.rate)
                for low, high, own, some in block.pieces(_SCORED):
                    many, at = high - low, a + low
                    add = lambda v: np.add.reduceat(v[some.sym], some.starts)  # noqa: B023, E731
                    columns = [
                        pa.array(np.arange(row, row + many) + (part << 40)),
                        batch.column(0).slice(at, many), batch.column(2).slice(at, many),
                        pa.array(some.sizes), pa.array(n_bytes[at : at + many]),
                        pa.array(add(counted)), pa.array(add(base)),
                        pa.array(text_scores(some, logs[own], model.code.escape)),
                        pa.array([list(r.items()) for r in some.rare], pa.map_(pa.binary(), pa.int32())),
                    ]
                    row += many
                    yield pa.RecordBatch.from_arrays(columns, names)

    names = ["row", "rid", "held", "n_tokens", "n_bytes", "n_known", "base", "bits", "rare"]
    schema = (
        f"row bigint, rid {kind}, held boolean, n_tokens bigint, n_bytes bigint, n_known bigint, base double,"
        " bits double, rare map<binary,int>"
    )
    scored = staged(slim.select("rid", "text", held_out).mapInArrow(run, schema), "lm-scored")
    held.destroy()

    # words behind the escape meet their counts and spellings
    spell = spark.sparkContext.broadcast(spell_tables(vocabulary.where("c > 0"), spec))
    new = min(max((int(once or 0) + 1) / (n_rare + 2), 1e-4), 0.999)

    def spelling(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array(spell.value.log10(batch.column(0).to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), found], ["word", "c", "spell"])

    marked = spark.createDataFrame([(w,) for w, _ in rows], "word binary") if rows else None
    others = vocabulary.join(F.broadcast(marked), "word", "left_anti") if rows else vocabulary
    spelled = others.mapInArrow(spelling, "word binary, c bigint, spell double")
    by_spelling = math.log10(new) + F.col("spell")
    by_count = F.log10((1 - new) * F.col("c") / max(n_rare, 1))
    chance = F.when(F.col("c") > 0, log_sum(by_count, by_spelling)).otherwise(by_spelling)  # a logarithm: long words underflow
    spelled = spelled.select(
        "word", (F.col("c") > 0).alias("seen"), (F.log10(F.col("c") + 1.0) - floor).alias("base"), chance.alias("chance")
    )
    rare = scored.select("row", F.explode("rare").alias("word", "n")).join(spelled, "word")
    sums = rare.groupBy("row").agg(
        F.sum(F.when(F.col("seen"), F.col("n")).otherwise(0)).alias("more_known"),
        F.sum(F.col("n") * F.col("base")).alias("more_base"),
        F.sum(F.col("n") * F.col("chance")).alias("by_chance"),
        F.sum(log_drawn(F.col("chance"), spec.urn, F.col("n"))).alias("drawn"),
        F.sum("n").alias("n_rare"),
    )
    by_urn = F.col("drawn") - log_rising(F.lit(spec.urn), F.col("n_rare"))
    sums = sums.withColumn("more_score", log_mean(F.col("by_chance"), by_urn))
    whole = scored.drop("rare").join(sums, "row", "left")
    total = F.col("bits") + F.coalesce("more_score", F.lit(0.0))
    return whole.select(
        F.col("rid").alias("doc_id"), F.col("held").alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(n_train).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        total.alias("score"),
        (-total / math.log10(2) / (F.col("n_bytes") + 1)).alias("bits_per_byte"),
    )
