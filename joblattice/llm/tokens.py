"""Token ids in a compressed file format with random access to single documents.

The format is one Parquet table whose rows are shards: ``payload`` is the documents' ids as
little-endian unsigned 32-bit integers, each document a zstandard frame of its own, made with one
dictionary that all shards share; ``index`` is the end offset of every frame (little-endian unsigned
64-bit), ``counts`` the number of ids of every document, ``ids`` the document ids in ascending order.
A shard names its dictionary by SHA-256 and tells where its ids begin within its part; the dictionary
and the total of each part stand in tables beside it. Spark writes and reads all of it, so any store
will do and a lost task leaves nothing behind.
"""

from __future__ import annotations

import hashlib
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from joblattice.llm.shared import hash_sample, sharded
from joblattice.session import scratch_path

END_ID = 2
#: The dictionary is trained on the ids of at most this many documents, chosen by a hash of the id.
DICTIONARY_DOCS, DICTIONARY_BYTES = 4_000, 112_640
#: A longer sampled document gives one piece of this size out of each of its quarters.
PIECE_BYTES, PIECES = 1024, 4
SHARD_BYTES = 1 << 20
LEVEL = 3
_CACHE_WORDS = 800_000
_SLICE_CHARS = 8_000_000
#: All characters that ``str.isspace`` takes (none lies beyond the first plane), and no character.
_BLANK = frozenset(["", *(c for c in map(chr, range(1 << 16)) if c.isspace())])


class Encoder:
    """Ids of whole texts by the tokenizers library, with the end id.

    The tokenizer joins a space to what follows it and nothing across it, and parts letters from a
    full stop or comma behind them. So a text in which each space stands alone is encoded as its words
    are, one after the other, and words met before come from a table. New words go to the library in
    one text; the byte lengths of the tokens tell them apart again. Other texts are encoded in one piece.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # a byte-level vocabulary writes each byte as one character; added tokens stand as they are
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():
            self.bytes[number] = len(token.encode()) if token in self.special else len(token)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.end = np.array([END_ID], "<u4").tobytes()
        self.marks = {m: self._ids(m).tobytes() for m in ".,"}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _learn(self, words: list[str]) -> None:
        """Put words, each behind a space, into the table."""
        ids = self._ids(" " + " ".join(words))
        ends = np.cumsum(self.bytes[ids])
        stops = np.cumsum(np.fromiter(map(len, map(str.encode, words)), np.int64, len(words)) + 1)
        at = np.searchsorted(ends, stops) + 1
        if ends[-1] != stops[-1] or (ends[at - 1] != stops).any():
            raise ValueError("the tokenizer joined two words")
        data, stops = ids.tobytes(), (4 * at).tolist()
        self.young.update(zip(words, map(data.__getitem__, map(slice, [0, *stops[:-1]], stops))))

    def _known(self, words: list[str]) -> list[bytes]:
        """The ids of distinct words behind a space, from the table or the library; nothing for odd ones.

        A word is odd if it is empty or has white space at an end, so that the space before or behind
        it does not stand alone.
        """
        if len(self.young) > _CACHE_WORDS:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        found = list(map(young.get, words))
        missing = [i for i, ids in enumerate(found) if ids is None]
        fresh, ended = {}, []
        for w in map(words.__getitem__, missing):
            if old and w in old:
                young[w] = old[w]
            elif w[:1] in _BLANK or w[-1] in _BLANK:
                young[w] = b""
            elif w[-1] in self.marks and w[:-1].isalpha():
                ended.append(w)
                if w[:-1] not in young and w[:-1] not in old:
                    fresh[w[:-1]] = None
            else:
                fresh[w] = None
        fresh = list(fresh)
        for at in range(0, len(fresh), 20_000):
            self._learn(fresh[at : at + 20_000])
        for w in ended:
            young[w] = (young.get(w[:-1]) or old[w[:-1]]) + self.marks[w[-1]]
        for i in missing:
            found[i] = young[words[i]]
        return found

    def _whole(self, text: str) -> bytes:
        return self._ids(text).tobytes() + self.end

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [i for i, t in enumerate(texts) if " " in t and not any(s in t for s in self.special)]
        out: list[bytes] = [b""] * len(texts)
        for i in set(range(len(texts))).difference(cut):
            out[i] = self._whole(texts[i])
        if not cut:
            return out
        heads = [texts[i].partition(" ")[0] for i in cut]
        rests = pc.split_pattern(pa.array([texts[i][len(h) + 1 :] for i, h in zip(cut, heads)], pa.large_string()), " ")
        coded = rests.flatten().dictionary_encode()
        words = self._known(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        pool = np.frombuffer(b"".join(words), "<u4")
        length = np.fromiter(map(len, words), np.int32, len(words)) >> 2
        start = np.cumsum(length, dtype=np.int32) - length
        at, offsets = coded.indices.to_numpy(), rests.offsets.to_numpy()
        sizes = length[at]
        odd = np.add.reduceat(sizes == 0, offsets[:-1], dtype=np.int32) > 0
        ends = np.cumsum(sizes, dtype=np.int32)  # a slice of texts is far from 2**31 ids
        where = np.arange(ends[-1], dtype=np.int32)
        where += np.repeat(start[at] - (ends - sizes), sizes)
        ids = pool[where]
        begin = 0
        for i, head, stop, strange in zip(cut, heads, ends[offsets[1:] - 1].tolist(), odd.tolist()):
            if strange or not head or head[-1].isspace():
                out[i] = self._whole(texts[i])
            else:
                out[i] = self._ids(head).tobytes() + ids[begin:stop].tobytes() + self.end
            begin = stop
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _encoded(batch: pa.RecordBatch, path: str) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, ids) of slices of a batch, each of bounded size or one text."""
    texts = ["" if t is None else t for t in batch.column(1).to_pylist()]
    for a, b in sharded(np.array([len(t) + 1 for t in texts]), _SLICE_CHARS):
        yield a, encoder(path).encode(texts[a:b])


def dictionary_pieces(ids: bytes) -> list[bytes]:
    """What the dictionary learns from one document: all of a short one, of a longer one pieces from each quarter.

    Where in its quarter a piece begins is told by a checksum of the whole document.
    """
    if len(ids) <= PIECE_BYTES * PIECES:
        return [ids]
    part, seed = len(ids) // 4 // PIECES, zlib.crc32(ids)
    room = part - PIECE_BYTES // 4 + 1
    starts = [4 * (q * part + zlib.crc32(bytes([q]), seed) % room) for q in range(PIECES)]
    return [ids[s : s + PIECE_BYTES] for s in starts]


def train_dictionary(docs: DataFrame, path: str, max_docs: int = DICTIONARY_DOCS) -> bytes:
    """A zstandard dictionary for the ids of a bounded sample; no dictionary if there is too little to learn."""
    sample = hash_sample(docs, F.col("doc"), max_docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, ids in _encoded(batch, path):
                pieces = [p for i in ids for p in dictionary_pieces(i)]
                yield pa.RecordBatch.from_arrays([pa.array(pieces, pa.binary())], ["ids"])

    samples = sorted(bytes(r[0]) for r in sample.mapInArrow(run, "ids binary").collect())
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


SHARD = (
    "part int, shard int, start bigint, n_docs int, n_tokens bigint, first_doc {kind}, last_doc {kind},"
    " dictionary string, ids array<{kind}>, counts binary, index binary, payload binary"
)


def write_tokens(
    docs: DataFrame, folder: str, path: str, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None
) -> str:
    """Write the format under ``folder``, in ascending order of id; returns the dictionary's hash.

    Null texts count as empty: their only id is the end. Rows without an id come first. Repeated rows
    are written as often as they occur. An empty table gives an empty file set.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    data = train_dictionary(slim, path)
    named = hashlib.sha256(data).hexdigest()
    shared = spark.sparkContext.broadcast(data)  # at most DICTIONARY_BYTES
    kind = slim.schema["doc"].dataType.simpleString()
    schema = T.StructType.fromDDL(SHARD.format(kind=kind))
    arrow = _arrow_schema(slim, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(shared.value), write_content_size=True)
        shard, start = 0, 0
        ids: list = []
        frames: list[bytes] = []
        counts: list[int] = []

        def flush() -> pa.RecordBatch:
            nonlocal shard, start
            row = {
                "part": part, "shard": shard, "start": start, "n_docs": len(ids), "n_tokens": sum(counts),
                "first_doc": ids[0], "last_doc": ids[-1], "dictionary": named, "ids": ids,
                "counts": np.array(counts, "<u4").tobytes(),
                "index": np.cumsum([len(f) for f in frames], dtype="<u8").tobytes(), "payload": b"".join(frames),
            }
            shard, start = shard + 1, start + sum(counts)
            return pa.RecordBatch.from_pylist([row], schema=arrow)

        size = 0
        for batch in batches:
            keys = batch.column(0).to_pylist()
            for at, found in _encoded(batch, path):
                for doc, raw in zip(keys[at:], found):
                    frame = press.compress(raw)
                    ids.append(doc)
                    frames.append(frame)
                    counts.append(len(raw) // 4)
                    size += len(frame)
                    if size >= SHARD_BYTES:
                        yield flush()
                        ids, frames, counts, size = [], [], [], 0
        if ids:
            yield flush()

    ordered = slim.repartitionByRange(parts, "doc") if parts else slim.repartitionByRange("doc")
    shards = ordered.sortWithinPartitions("doc").mapInArrow(run, schema)
    shards.write.option("compression", "none").mode("overwrite").parquet(f"{folder}/shards")
    spark.createDataFrame([(named, bytearray(data))], "dictionary string, data binary").coalesce(1).write.mode(
        "overwrite"
    ).parquet(f"{folder}/dictionary")
    return named


def _arrow_schema(slim: DataFrame, schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def load_dictionary(spark: SparkSession, folder: str) -> tuple[str, bytes]:
    """(hash, data); fails if the data does not have the hash it is stored under."""
    row = spark.read.parquet(f"{folder}/dictionary").first()
    data = bytes(row[1])
    if hashlib.sha256(data).hexdigest() != row[0]:
        raise ValueError("the dictionary does not match its hash")
    return row[0], data


def frames_of(shard: dict, wanted: set | None, data: bytes) -> Iterator[tuple]:
    """(doc, start within the part, ids) of the documents of one shard, or of the wanted ones only."""
    unpress = zstandard.ZstdDecompressor(dict_data=_dictionary(data))
    ends = np.frombuffer(shard["index"], "<u8")
    counts = np.frombuffer(shard["counts"], "<u4").astype(np.int64)
    starts = shard["start"] + np.cumsum(counts) - counts
    payload = memoryview(shard["payload"])
    for i, doc in enumerate(shard["ids"]):
        if wanted is None or doc in wanted:
            yield doc, int(starts[i]), unpress.decompress(payload[int(ends[i - 1]) if i else 0 : int(ends[i])])


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """doc_id, start (ids before the document in the whole file set), n_tokens, ids_crc32 and the ids."""
    named, data = load_dictionary(spark, folder)
    shared = spark.sparkContext.broadcast(data)
    shards = spark.read.parquet(f"{folder}/shards")
    # one total per part: as many rows as the write had tasks
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()
    before = np.cumsum([0] + [r["n"] for r in totals])
    base = {r["part"]: int(b) for r, b in zip(totals, before)}
    kind = shards.schema["first_doc"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.to_pylist():
                if shard["dictionary"] != named:
                    raise ValueError("a shard needs another dictionary")
                rows = [(d, base[shard["part"]] + s, raw) for d, s, raw in frames_of(shard, None, shared.value)]
                columns = [
                    pa.array([r[0] for r in rows], batch.schema.field("first_doc").type),
                    pa.array([r[1] for r in rows], pa.int64()),
                    pa.array([len(r[2]) // 4 for r in rows], pa.int64()),
                    pa.array([zlib.crc32(r[2]) for r in rows], pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.array([np.frombuffer(r[2], "<u4").astype(np.int64) for r in rows], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["token_ids"] * with_ids
    schema = f"doc_id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint" + ", token_ids array<bigint>" * with_ids
    return shards.mapInArrow(run, schema)


def read_documents(spark: SparkSession, folder: str, doc_ids: list) -> dict:
    """The ids of single documents: only shards whose range holds one are read, only their frames unpacked."""
    _, data = load_dictionary(spark, folder)
    shards, wanted, out = spark.read.parquet(f"{folder}/shards"), set(doc_ids), {}
    hit = F.lit(False)
    for d in wanted:
        hit = hit | ((F.col("first_doc") <= d) & (F.col("last_doc") >= d))
    for row in shards.where(hit).toLocalIterator():
        out.update({doc: np.frombuffer(raw, "<u4").tolist() for doc, _, raw in frames_of(row.asDict(), wanted, data)})
    return out


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Write the ids of all documents to the shared folder, and what reading them back gives."""
    folder = scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, folder, path)
    return read_tokens(docs.sparkSession, folder, with_ids=False)
