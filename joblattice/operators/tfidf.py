"""TF-IDF term models over any number of documents.

Layout of the work: each text is split where it lies and its words are counted in Arrow batches (``counting``);
the text itself never travels. Vocabulary, weights and norms of one plan share one shuffle of the term
counts by document. A vocabulary that is written first leaves only the terms it has kept to be moved,
once, for the norms. Per-term counts are summed per task before they travel. A vocabulary cut to
``max_features`` terms is bounded by that number and broadcast, and only terms that may reach the cut are
summed for it (``frequent_buckets``); an uncut one is written and measured first.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from joblattice.constants import MAX_FEATURES, NGRAM_RANGE
from joblattice.functions.text import word_tokens
from joblattice.operators import counting
from joblattice.operators.dictionary import lemmatized_tokens
from joblattice.operators.rows import repeated_sums
from joblattice.session import broadcast_if_small, is_small, scratch_path, spread, written

DOC, TERM = "doc_id", "term"
CUT_MAX_TERMS = 50_000


@dataclass(frozen=True)
class Spec:
    """What the model counts. ``max_features=None`` keeps every term.

    ``min_df``/``max_df`` are document counts when int and shares of all documents when float.
    """

    max_features: int | None = MAX_FEATURES
    ngram_range: tuple[int, int] = NGRAM_RANGE
    min_df: int | float = 1
    max_df: int | float = 1.0
    sublinear_tf: bool = False
    stopwords: tuple[str, ...] = ()


STORED = Spec()
ON_THE_FLY = replace(STORED, max_features=None, ngram_range=(1, 1))


@dataclass(frozen=True)
class Model:
    """``vocab(term, cf, df, idf)`` and ``postings(doc_id, term, weight)``.

    A placed model has its postings in files by frequency ``band`` of the term, and
    ``bounds(term, df, band, top)`` with the largest weight of each term.
    """

    vocab: DataFrame
    postings: DataFrame
    spec: Spec
    bounds: DataFrame | None = None


def need_column(df: DataFrame, name: str) -> None:
    if name not in df.columns:
        raise ValueError(f"Field '{name}' not found in {df.columns}")


def _named(column: str, name: str) -> Column:
    """The column under ``name``, without an alias that changes nothing.

    Such an alias is dropped in one use of a plan and kept in another, and then the shuffle over it
    is no longer shared.
    """
    return F.col(column) if column == name else F.col(column).alias(name)


def word_lists(docs: DataFrame, key: str, text: str, spec: Spec = STORED, lemmas: DataFrame | None = None) -> DataFrame:
    """``(doc_id, words)`` for every document, in text order and without the stopwords.

    Texts stay where they lie, unless their files give the scan fewer tasks than there are cores.
    """
    need_column(docs, text)
    if lemmas is None:
        texts = spread(docs.select(_named(key, DOC), _named(text, "text")))
        words: Column = word_tokens(F.col("text"))
    else:
        texts = lemmatized_tokens(docs, key, text, lemmas).select(_named(key, DOC), "tokens")
        words = F.col("tokens")
    if spec.stopwords:
        stop = F.array(*[F.lit(w) for w in spec.stopwords])
        words = F.filter(words, lambda w: ~F.array_contains(stop, w))
    return texts.select(DOC, words.alias(counting.WORDS))


def term_counts(
    docs: DataFrame,
    key: str,
    text: str,
    spec: Spec = STORED,
    lemmas: DataFrame | None = None,
    placed: bool = False,
) -> DataFrame:
    """``(doc_id, term, tf)`` for every n-gram of every document; documents without terms have no row.

    Each text is counted by itself, so nothing is grouped over documents. ``placed`` counts are
    hash-partitioned by document, one array a document, for sums per document in the same plan.
    """
    return list_counts(word_lists(docs, key, text, spec, lemmas), spec, placed=placed)


def list_counts(lists: DataFrame, spec: Spec = STORED, kept: bytes | None = None, placed: bool = False) -> DataFrame:
    """As ``term_counts``, from word lists; of other buckets than the ``kept`` ones nothing is counted."""
    if not placed:
        return counting.counts(lists, *spec.ngram_range, kept)
    held = counting.counts(lists, *spec.ngram_range, kept, arrays=True).repartition(DOC)
    # The plain generator would have Spark count every text a second time, to leave out those without terms.
    return held.select(DOC, F.inline_outer("counts")).filter(F.col(TERM).isNotNull())


def corpus_counts(counts: DataFrame) -> DataFrame:
    """``(term, cf, df)``: total occurrences and number of documents."""
    return counts.groupBy(TERM).agg(F.sum("tf").alias("cf"), F.count(F.lit(1)).alias("df"))


def _cutoff(bound: int | float, n_docs: Column) -> Column:
    return F.lit(bound) if isinstance(bound, int) else F.lit(bound) * n_docs


LEVELS_PER_OCTAVE = 16


def _cut_at(rows: DataFrame, key: Column, wanted: Column) -> Column:
    """``(key, above)`` as a scalar: the key at which ``wanted`` rows are reached, smallest keys first, and the rows before it."""
    heights = rows.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n"))
    kind = heights.schema["key"].dataType.simpleString()
    start = F.struct(F.lit(None).cast(kind).alias("key"), F.lit(0).cast("bigint").alias("above"), F.lit(0).cast("bigint").alias("seen"))

    def further(at: Column, height: Column) -> Column:
        step = F.struct(height["key"].alias("key"), at["seen"].alias("above"), (at["seen"] + height["n"]).alias("seen"))
        return F.when(at["seen"] < F.col("wanted"), step).otherwise(at)

    listed = heights.agg(F.array_sort(F.collect_list(F.struct("key", "n"))).alias("all")).withColumn("wanted", wanted)
    return listed.select(F.aggregate("all", start, further)).scalar()


def down_to_cut(totals: DataFrame, size: int) -> DataFrame:
    """The terms of highest ``cf`` down to the cut after ``size`` of them, and those with the cut's ``cf`` and first two letters.

    A histogram over levels of ``cf`` (at most a thousand) finds the level in which the cut lies, one over
    ``cf`` and first two letters the place in that level.
    """
    rows = totals.filter(F.col("df") > 0)
    level = -F.floor(F.log2("cf") * LEVELS_PER_OCTAVE)
    place = F.struct((-F.col("cf")).alias("cf"), F.left(TERM, F.lit(2)).alias("head"))
    first = _cut_at(rows, level, F.lit(size))
    second = _cut_at(rows.filter(level == first["key"]), place, F.lit(size) - first["above"])
    return rows.filter((level < first["key"]) | ((level == first["key"]) & (place <= second["key"])))


def most_frequent(totals: DataFrame, size: int) -> DataFrame:
    """The ``size`` terms of highest ``cf``, ties to the alphabetically smaller; only terms down to the cut are put in order."""
    return down_to_cut(totals, size).orderBy(F.desc("cf"), F.asc(TERM)).limit(size)


def _passing(totals: DataFrame, n_docs: Column, spec: Spec) -> DataFrame:
    """The terms within ``min_df`` and ``max_df``."""
    kept = totals
    if spec.min_df != 1:
        kept = kept.filter(F.col("df") >= _cutoff(spec.min_df, n_docs))
    if spec.max_df != 1.0:
        kept = kept.filter(F.col("df") <= _cutoff(spec.max_df, n_docs))
    return kept


def build_vocab(totals: DataFrame, n_docs: Column, spec: Spec = STORED) -> DataFrame:
    """Vocabulary with smooth idf ``ln((1+n)/(1+df)) + 1``; ``n_docs`` counts empty documents too.

    At the ``max_features`` cut more frequent terms win, then the alphabetically smaller.
    """
    kept = _passing(totals, n_docs, spec)
    if spec.max_features is not None:
        kept = most_frequent(kept, spec.max_features)
    return kept.withColumn("idf", F.log((1 + n_docs) / (1 + F.col("df"))) + 1.0)


def _nth_largest(rows: DataFrame, name: str, n: int) -> int:
    """The ``n``-th largest value, 0 if there are fewer."""
    size, least = rows.select(name).orderBy(F.desc(name)).limit(n).agg(F.count(F.lit(1)), F.min(name)).first()
    return least if size == n and n else 0


def _sums_to_cut(lists: DataFrame, n_docs: Column, spec: Spec) -> tuple[bytes | None, int, DataFrame]:
    """``(buckets, floor, totals)``: corpus counts of all terms in the buckets whose sum reaches ``floor``.

    No term of another bucket occurs ``floor`` times, and ``max_features`` terms do, so none of them is cut in
    favour of one left out. The first floor is a guess; where too few terms reach it, the count of the last
    of the best found so far is one that holds, and the terms are summed once more.
    """
    size = spec.max_features
    sums = written(counting.bucket_sums(lists, *spec.ngram_range), "buckets")
    floor = _nth_largest(sums, "n", 2 * size)
    while True:
        kept = None
        if floor > 1:
            reached = sums.filter(F.col("n") >= floor).select("bucket").toArrow().column("bucket")
            kept = counting.packed(reached.to_numpy())
        totals = written(counting.totals(lists, *spec.ngram_range, kept), "totals")
        if kept is None:
            return None, 0, totals
        passing = _passing(totals, n_docs, spec)
        if passing.filter(F.col("cf") >= floor).count() >= size:
            return kept, floor, totals
        floor = _nth_largest(passing, "cf", size)


def frequent_buckets(lists: DataFrame, n_docs: Column, spec: Spec = STORED) -> bytes | None:
    """Buckets that hold every term of a cut vocabulary; None where that is no bound.

    For word lists without lemmas: a lemma may hold a blank and so equal a pair of words of another bucket.
    """
    return _sums_to_cut(lists, n_docs, spec)[0] if is_cut(spec) else None


def list_vocabulary(lists: DataFrame, n_docs: Column, spec: Spec = STORED, lemmas: bool = False) -> DataFrame:
    """The vocabulary of word lists; for a cut one, rare terms are never summed by term."""
    if lemmas or not is_cut(spec):
        return build_vocab(counting.totals(lists, *spec.ngram_range), n_docs, spec)
    _, floor, totals = _sums_to_cut(lists, n_docs, spec)
    return build_vocab(totals.filter(F.col("cf") >= floor), n_docs, spec)


def vocab_buckets(vocab: DataFrame, spec: Spec, lemmas: bool = False) -> bytes | None:
    """The buckets of a written cut vocabulary, at most ``CUT_MAX_TERMS`` terms; None for any other."""
    if lemmas or not is_cut(spec):
        return None
    return counting.packed(counting.buckets_of([r[TERM] for r in vocab.select(TERM).collect()]))


def with_term_ids(vocab: DataFrame) -> DataFrame:
    """Numbers the terms of a vocabulary of any size alphabetically from 0; writes it down to do so.

    Terms are dealt by ranges and numbered inside them; the sizes of the ranges, one a partition, give
    where each begins.
    """
    spark = vocab.sparkSession
    at = F.monotonically_increasing_id()
    ranges = written(vocab.repartitionByRange(TERM).sortWithinPartitions(TERM).withColumn("_at", at), "numbered")
    part = F.shiftright("_at", 33)
    sizes = ranges.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("n")).orderBy("_part").collect()
    begins = zip((r["_part"] for r in sizes), accumulate((r["n"] for r in sizes), initial=0))
    offsets = F.broadcast(spark.createDataFrame(list(begins), "_part bigint, _begin bigint"))
    inside = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    numbered = ranges.withColumn("_part", part).join(offsets, "_part").withColumn("term_id", F.col("_begin") + inside)
    return numbered.drop("_part", "_begin", "_at")


def weigh(counts: DataFrame, vocab: DataFrame, spec: Spec = STORED, *carried: str) -> DataFrame:
    """L2-normalised tf-idf weights; terms outside the vocabulary fall away.

    A vocabulary cut to few enough terms is broadcast unseen; any other is measured first, and
    joined by term if it is too large. Columns of the vocabulary named in ``carried`` come along. With the
    numbers of a cut vocabulary (``with_term_ids``, written) these are moved in place of the terms.
    """
    tf = F.log(F.col("tf")) + 1.0 if spec.sublinear_tf else F.col("tf").cast("double")
    raw, norm = (tf * F.col("idf")).alias("raw"), F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(DOC)))
    weight = (F.col("raw") / norm).alias("weight")
    if is_cut(spec) and "term_id" in vocab.columns:
        number = F.col("term_id").alias("_id")
        moved = counts.join(F.broadcast(vocab.select(TERM, number)), TERM).select(DOC, "_id", "tf").repartition(DOC)
        slim = moved.join(F.broadcast(vocab.select("idf", number)), "_id").select(DOC, "_id", raw).select(DOC, "_id", weight)
        named = F.broadcast(vocab.select(TERM, *carried, number))  # behind the sort by document, which so holds no text
        return slim.join(named, "_id").select(DOC, TERM, "weight", *carried)
    terms = vocab.select(TERM, "idf", *carried)
    near = F.broadcast(terms) if is_cut(spec) else broadcast_if_small(terms)
    return counts.join(near, TERM).select(DOC, TERM, raw, *carried).select(DOC, TERM, weight, *carried)


def weigh_lists(lists: DataFrame, vocab: DataFrame, spec: Spec, lemmas: bool, *carried: str) -> DataFrame:
    """As ``weigh`` of the counts of written word lists, under a written vocabulary with ``term_id``.

    With a cut vocabulary a document that is one row is weighed where it lies, so no count is moved. Only
    rows whose document repeats, null counting as one, are dealt by document; where these are many, all are.
    """
    kept = vocab_buckets(vocab, spec, lemmas)
    met = repeated_sums(lists, [DOC]) if is_cut(spec) else None
    if met is None or not is_small(met):
        return weigh(list_counts(lists, spec, kept), vocab, spec, *carried)
    alone, several = lists, None
    if not met.isEmpty():
        marked, sums = lists.withColumn("sum", F.xxhash64(DOC)), F.broadcast(met)
        alone = marked.join(sums, "sum", "left_anti").drop("sum")
        several = marked.join(sums, "sum", "left_semi").drop("sum")
    terms = vocab.select(TERM, "idf", "term_id").orderBy("term_id").collect()
    found = counting.weights(alone, *spec.ngram_range, kept, [r[TERM] for r in terms], [r["idf"] for r in terms], spec.sublinear_tf)
    numbered = F.broadcast(vocab.select(TERM, *carried, F.col("term_id").alias("_id")))
    weights = found.join(numbered, "_id").select(DOC, TERM, "weight", *carried)
    if several is None:
        return weights
    return weights.unionByName(weigh(list_counts(several, spec, kept), vocab, spec, *carried))


def count_docs(docs: DataFrame) -> Column:
    """The number of documents as a scalar inside the plan."""
    return docs.agg(F.count(F.lit(1))).scalar()


def vocabulary(docs: DataFrame, key: str, text: str, spec: Spec = STORED, lemmas: DataFrame | None = None) -> DataFrame:
    """The vocabulary alone; a cut one is summed at once, of the terms that may reach the cut."""
    return list_vocabulary(word_lists(docs, key, text, spec, lemmas), count_docs(docs), spec, lemmas is not None)


def fit(
    docs: DataFrame,
    key: str,
    text: str,
    spec: Spec = STORED,
    lemmas: DataFrame | None = None,
    written_vocab: bool = False,
) -> Model:
    """Vocabulary and postings in one lazy plan that shuffles the term counts once for both.

    ``written_vocab`` counts the vocabulary at once and keeps it in the shared folder, for large corpora and for a
    model that several jobs will read: only terms it has kept are moved. An uncut vocabulary always is, since it
    has to be measured.
    """
    if written_vocab or not is_cut(spec):
        lists = word_lists(docs, key, text, spec, lemmas)
        vocab = written(list_vocabulary(lists, count_docs(docs), spec, lemmas is not None), "vocabulary")
        counts = list_counts(lists, spec, vocab_buckets(vocab, spec, lemmas is not None))
        return Model(vocab, weigh(counts, vocab, spec), spec)
    counts = term_counts(docs, key, text, spec, lemmas, placed=True)
    return from_counts(counts, corpus_counts(counts), count_docs(docs), spec)


def is_cut(spec: Spec) -> bool:
    """Whether the settings alone bound the vocabulary to a size that may be broadcast."""
    return spec.max_features is not None and spec.max_features <= CUT_MAX_TERMS


def from_counts(counts: DataFrame, totals: DataFrame, n_docs: Column, spec: Spec = STORED) -> Model:
    """As ``fit``, from term counts that are at hand."""
    vocab = build_vocab(totals, n_docs, spec)
    if not is_cut(spec):
        vocab = written(vocab, "vocabulary")
    return Model(vocab, weigh(counts, vocab, spec), spec)


# --- postings ready for ranking -------------------------------------------------------------------


def band(df: Column) -> Column:
    """Frequency class of a term: four times as many documents are one class further."""
    return F.floor(F.log2(df) / 2).cast("int")


def place(counts: DataFrame, vocab: DataFrame, spec: Spec, postings_path: str, bounds_path: str) -> Model:
    """Write postings into a folder for each frequency band of their term, and the largest weight of each term.

    Whoever reads rare terms only leaves the folders of the common ones, where most rows lie, alone.
    """
    terms = vocab.withColumn("band", band(F.col("df")))
    return _place(weigh(counts, terms, spec, "band"), terms, spec, postings_path, bounds_path)


def place_lists(lists: DataFrame, vocab: DataFrame, spec: Spec, lemmas: bool, postings_path: str, bounds_path: str) -> Model:
    """As ``place``, from written word lists and a written vocabulary with ``term_id``."""
    terms = vocab.withColumn("band", band(F.col("df")))
    return _place(weigh_lists(lists, terms, spec, lemmas, "band"), terms, spec, postings_path, bounds_path)


def _place(weights: DataFrame, terms: DataFrame, spec: Spec, postings_path: str, bounds_path: str) -> Model:
    spark = weights.sparkSession
    weights.write.mode("errorifexists").partitionBy("band").parquet(postings_path)
    schema = f"{DOC} {weights.schema[DOC].dataType.simpleString()}, {TERM} string, weight double, band int"
    postings = spark.read.schema(schema).parquet(postings_path)
    tops = postings.groupBy(TERM).agg(F.max("weight").alias("top"))
    bounds = terms.select(TERM, "df", "band").join(F.broadcast(tops) if is_cut(spec) else tops, TERM)
    bounds.write.mode("errorifexists").parquet(bounds_path)
    return Model(terms.drop("band"), postings, spec, spark.read.parquet(bounds_path))


def placed(docs: DataFrame, key: str, text: str, vocab: DataFrame, spec: Spec = STORED, lemmas: DataFrame | None = None) -> Model:
    """A model under a written vocabulary with its postings in the shared folder, by band and with bounds."""
    folder = scratch_path(docs.sparkSession, "postings")
    counts = list_counts(word_lists(docs, key, text, spec, lemmas), spec, vocab_buckets(vocab, spec, lemmas is not None))
    return place(counts, vocab, spec, folder, f"{folder}-bounds")


def transform(
    texts: DataFrame,
    key: str,
    text: str,
    vocab: DataFrame,
    spec: Spec = STORED,
    lemmas: DataFrame | None = None,
) -> DataFrame:
    """Weights of new texts under an existing vocabulary."""
    return weigh(term_counts(texts, key, text, spec, lemmas), vocab, spec)


# --- incremental update ---------------------------------------------------------------------------


def _ids(changed: DataFrame, key: str) -> DataFrame:
    return broadcast_if_small(changed.select(F.col(key).alias(DOC)).distinct())


def replace_counts(stored: DataFrame, changed: DataFrame, key: str, fresh: DataFrame) -> DataFrame:
    """Stored term counts (or word lists) with those of the documents in ``changed`` exchanged for ``fresh`` ones.

    The documents are taken from ``changed`` itself, since one edited to nothing has no fresh counts.
    """
    return stored.join(_ids(changed, key), DOC, "left_anti").unionByName(fresh)


def shift_totals(totals: DataFrame, stored: DataFrame, changed: DataFrame, key: str, fresh: DataFrame) -> DataFrame:
    """Corpus counts after ``replace_counts``, from the changed documents' rows alone."""
    gone = corpus_counts(stored.join(_ids(changed, key), DOC, "left_semi"))
    gone = gone.select(TERM, (-F.col("cf")).alias("cf"), (-F.col("df")).alias("df"))
    moved = totals.select(TERM, "cf", "df").unionByName(gone).unionByName(corpus_counts(fresh))
    summed = moved.groupBy(TERM).agg(F.sum("cf").alias("cf"), F.sum("df").alias("df"))
    return summed.filter(F.col("df") > 0)
