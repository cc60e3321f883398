"""Text search over listings: case-insensitive containment and trigram similarity."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from joblattice.constants import TRIGRAM_THRESHOLD
from joblattice.functions.text import let
from joblattice.functions.trigram import distinct_words, shared_share, trigrams
from joblattice.operators import gram_sets
from joblattice.operators.gram_sets import bucket_of
from joblattice.operators.rows import first_per_key
from joblattice.session import broadcast_if_small, is_small, spread, written


def like_escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")


def contains_ignore_case(column: str, text: str) -> Column:
    return F.ilike(F.col(column), F.lit(f"%{like_escape(text)}%"))


def search(
    jobs: DataFrame,
    as_of: Column,
    days: int = 14,
    date_column: str = "posted_date",
    **contains: str,
) -> DataFrame:
    """Rows of the last ``days`` whose named columns contain the given texts, newest first."""
    hits = jobs.filter(F.col(date_column) >= F.date_sub(as_of, days))
    for column, text in contains.items():
        hits = hits.filter(contains_ignore_case(column, text))
    return hits.orderBy(F.desc(date_column))


def fuzzy_search(
    docs: DataFrame,
    key: str,
    text: str,
    query: str,
    threshold: float = TRIGRAM_THRESHOLD,
    top_n: int = 20,
) -> DataFrame:
    """Best ``top_n`` documents by trigram similarity to one query, ties by key; no shuffle before the cut."""
    wanted = trigrams(F.lit(query))
    score = let(trigrams(F.col(text)), lambda t: shared_share(t, wanted))
    hits = docs.withColumn("similarity", score).filter(F.col("similarity") >= threshold)
    return hits.orderBy(F.desc("similarity"), F.asc(key)).limit(top_n)


#: Rows of one trigram in one task, where the side of the queries is too large to be broadcast.
SALT_ROWS = 100_000
_ROUNDING = 1e-9


def _at_least(value: Column) -> Column:
    """The smallest whole number not below ``value``, whatever its last digits."""
    return F.ceil(value - _ROUNDING)


def gram_postings(sets: DataFrame, key: str) -> DataFrame:
    """``(key, size, gram)`` of ``sets(key, size, grams)``."""
    return sets.select(key, "size", F.explode("grams").alias("gram"))


def query_grams(queries: DataFrame, frequencies: DataFrame, threshold: float) -> DataFrame:
    """``(query_id, query_size, gram, df, first)``: the trigrams of each query, the rarest marked ``first``.

    Of m trigrams a hit shares at least threshold * m, so it holds one of any m - threshold * m + 1; the
    rarest are taken. Trigrams that no text has count as the rarest of all and cost nothing.
    """
    grams = queries.select("query_id", trigrams(F.col("query")).alias("grams"))
    rows = grams.select("query_id", F.size("grams").alias("query_size"), F.explode("grams").alias("gram"))
    rows = rows.join(broadcast_if_small(frequencies), "gram", "left").na.fill(0, ["df"])
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("df", "gram"))
    needed = F.col("query_size") - _at_least(F.col("query_size") * threshold) + 1
    return rows.withColumn("first", place <= needed)


def meet(postings: DataFrame, asked: DataFrame, key: str) -> DataFrame:
    """Postings beside the trigrams of the queries; frequent trigrams are dealt to several tasks."""
    terms = asked.select("query_id", "query_size", "gram", "df")
    if is_small(terms):
        return postings.join(F.broadcast(terms.drop("df")), "gram")
    salts = F.ceil(F.col("df") / SALT_ROWS).cast("int")
    heavy = terms.filter(F.col("df") > SALT_ROWS).select("gram", salts.alias("salts")).distinct()
    dealt = postings.join(broadcast_if_small(written(heavy, "heavy-grams")), "gram", "left")
    dealt = dealt.withColumn("salt", F.pmod(F.hash(key), F.coalesce("salts", F.lit(1)))).drop("salts")
    copies = terms.withColumn("salt", F.explode(F.sequence(F.lit(0), F.greatest(salts, F.lit(1)) - 1))).drop("df")
    return dealt.join(copies, ["gram", "salt"])


#: Share of all meetings of trigrams behind the rarest ones from which on a first round over these spares too little.
ONE_ROUND_SHARE = 0.25


def _one_round(asked: DataFrame) -> bool:
    """Whether the rarest trigrams alone bring so many meetings that all are counted at once."""
    rare, every = asked.agg(F.sum(F.when(F.col("first"), F.col("df"))), F.sum("df")).first()
    return (rare or 0) > ONE_ROUND_SHARE * (every or 0)


def similar(
    postings: DataFrame,
    asked: DataFrame,
    key: str,
    threshold: float,
    sets: Callable[[DataFrame], DataFrame],
    read=lambda postings, asked: postings,
    top_n: int | None = None,
) -> DataFrame:
    """``(query_id, key, similarity)`` of all texts that reach the threshold; ``asked`` is written.

    Texts and queries first meet on each query's rarest trigrams alone. A text whose share of those,
    with all the others added, could not reach the threshold is out; the common trigrams are counted
    for the rest. ``read`` narrows the postings to what the given trigrams need.

    Where the rarest trigrams bring a large part of all meetings, all are counted at once instead: ``sets`` gives
    ``(key, size, grams)``, any number of rows a text, with all the trigrams asked for. They are brought together by
    text, so that queries and texts meet and are counted in one task (``gram_sets``), and no row a query and
    text is shuffled. With ``top_n``, texts that are not among the best so many may then be left out.
    """
    if _one_round(asked) and is_small(asked.select("query_id", "query_size", "gram")):
        return _similar_at_once(sets(asked), asked, key, threshold, top_n)
    rare, common = asked.filter("first"), asked.filter("NOT first")
    group = ["query_id", key, "size", "query_size"]
    met = meet(read(postings, rare), rare, key).filter(_possible(threshold))
    needed = _at_least((F.col("size") + F.col("query_size")) * (threshold / (1 + threshold)))
    left = F.greatest(_at_least(F.col("query_size") * threshold) - 1, F.lit(0))
    alive = met.groupBy(*group).agg(F.count(F.lit(1)).alias("common")).filter(F.col("common") >= needed - left)
    alive = written(alive, "similar-candidates")
    near = broadcast_if_small(alive.drop("common"))
    held = read(postings, common).join(broadcast_if_small(alive.select(key).distinct()), key, "left_semi")
    rest = meet(held, common, key).join(near, group).groupBy(*group).agg(F.count(F.lit(1)).alias("common"))
    counted = alive.unionByName(rest).groupBy(*group).agg(F.sum("common").alias("common"))
    return _scored(counted, key, threshold)


def _possible(threshold: float) -> Column:
    """Whether the sizes of a text's and a query's sets let them reach the threshold."""
    return F.least("size", "query_size") >= F.greatest("size", "query_size") * F.lit(threshold) - _ROUNDING


def _scored(counted: DataFrame, key: str, threshold: float) -> DataFrame:
    score = F.col("common") / (F.col("size") + F.col("query_size") - F.col("common"))
    return counted.select("query_id", key, score.alias("similarity")).filter(F.col("similarity") >= threshold)


def _similar_at_once(sets: DataFrame, asked: DataFrame, key: str, threshold: float, top_n: int | None) -> DataFrame:
    rows = asked.select("query_id", "query_size", "gram").collect()  # within the bounds of a broadcast
    if not rows:
        kinds = [F.lit(None).cast(asked.schema["query_id"].dataType).alias("query_id"), F.col(key), F.lit(0.0).alias("similarity")]
        return sets.select(*kinds).limit(0)
    known, sizes = gram_sets.Asked(rows), [r["query_size"] for r in rows]
    held = gram_sets.numbered(sets.filter(_size_between(min(sizes), max(sizes), threshold)), key, known)
    held = held.repartition(F.col(key)).sortWithinPartitions(key, "size")
    kind = asked.schema["query_id"].dataType
    return _scored(gram_sets.shared(held, key, known, kind, threshold, top_n), key, threshold)


def _size_between(shortest: int | None, longest: int | None, threshold: float) -> Column:
    """Whether a set is neither too small nor too large for every query."""
    size, low, high = F.col("size"), F.lit(shortest), F.lit(longest)
    return (size >= low * threshold - _ROUNDING) & (size * threshold <= high + _ROUNDING)


def fuzzy_search_many(
    docs: DataFrame,
    key: str,
    text: str,
    queries: DataFrame,
    threshold: float = TRIGRAM_THRESHOLD,
    top_n: int = 20,
) -> DataFrame:
    """As ``fuzzy_search`` for a table ``queries(query_id, query)``: ``(query_id, key, similarity)``.

    Each text becomes the set of its trigrams where it lies, and those sets are written; texts too long
    or too short for every query are left out. No text is shuffled.
    """
    sizes = queries.select(F.size(trigrams(F.col("query"))).alias("n")).agg(F.min("n"), F.max("n"))
    shortest, longest = sizes.first()
    grams = spread(docs.select(key, text)).select(F.col(key), trigrams(F.col(text)).alias("grams"))
    sets = written(grams, "gram-sets").withColumn("size", F.size("grams"))
    sets = sets.filter(_size_between(shortest, longest, threshold))
    postings = gram_postings(sets, key)
    wanted = queries.select(F.explode(trigrams(F.col("query"))).alias("gram")).distinct()
    frequencies = postings.join(broadcast_if_small(wanted), "gram", "left_semi").groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
    asked = written(query_grams(queries, written(frequencies, "gram-counts"), threshold), "query-grams")
    return _best(similar(postings, asked, key, threshold, lambda _: sets, top_n=top_n), key, top_n)


def _best(scored: DataFrame, key: str, top_n: int) -> DataFrame:
    return first_per_key(scored, ["query_id"], [F.desc("similarity"), F.asc(key)], top_n)


# --- a stored index -------------------------------------------------------------------------------

BUCKETS = 64
_POSTINGS = "size int, grams array<string>, bucket int"


def write_index(docs: DataFrame, key: str, text: str, path: str, buckets: int = BUCKETS) -> None:
    """Write ``postings`` into a folder for each bucket of trigrams, with the size of each text's set, and their counts.

    A row holds what a text has in one bucket. ``buckets`` grows with the table: a query reads the buckets of its
    trigrams, whole. A bucket is dealt to many tasks by text, and so to many files.
    """
    spark = docs.sparkSession
    texts = spread(docs.select(key, text)).select(F.col(key), distinct_words(F.col(text)).alias("words"))
    rows = gram_sets.by_bucket(texts, key, buckets)
    part = F.pmod(F.xxhash64(key), F.lit(spark.sparkContext.defaultParallelism))
    placed = rows.repartition("bucket", part).sortWithinPartitions("bucket", key)
    placed.write.mode("errorifexists").partitionBy("bucket").parquet(f"{path}/postings")
    held = spark.read.schema(f"{_kinds(docs, key)}, {_POSTINGS}").parquet(f"{path}/postings")
    counts = held.select("bucket", F.explode("grams").alias("gram")).groupBy("bucket", "gram")
    counts = counts.agg(F.count(F.lit(1)).alias("df")).repartition("bucket")
    counts.write.mode("errorifexists").partitionBy("bucket").parquet(f"{path}/counts")
    spark.range(1).select(F.lit(buckets).alias("buckets"), F.lit(_kinds(docs, key)).alias("key")).write.parquet(f"{path}/layout")


def _kinds(docs: DataFrame, key: str) -> str:
    return f"`{key}` {docs.schema[key].dataType.simpleString()}"


def fuzzy_search_indexed(
    spark: SparkSession,
    path: str,
    key: str,
    queries: DataFrame,
    threshold: float = TRIGRAM_THRESHOLD,
    top_n: int = 20,
) -> DataFrame:
    """As ``fuzzy_search_many`` from a written index: only the buckets of the queries' trigrams are read."""
    layout = spark.read.parquet(f"{path}/layout").first()
    buckets = layout["buckets"]
    held = spark.read.schema(f"{layout['key']}, {_POSTINGS}").parquet(f"{path}/postings")
    counts = spark.read.schema("gram string, df bigint, bucket int").parquet(f"{path}/counts")

    def read(rows: DataFrame, asked: DataFrame) -> DataFrame:
        wanted = asked.select(bucket_of(F.col("gram"), buckets).alias("b")).distinct()
        return rows.filter(F.col("bucket").isin([r["b"] for r in wanted.collect()]))  # at most as many as there are buckets

    wanted = queries.select(F.explode(trigrams(F.col("query"))).alias("gram")).distinct()
    known = read(counts, wanted).join(broadcast_if_small(wanted), "gram").select("gram", "df")
    asked = written(query_grams(queries, known, threshold), "query-grams")
    postings = lambda rows, asked: gram_postings(read(rows, asked), key)
    return _best(similar(held, asked, key, threshold, lambda asked: read(held, asked), postings, top_n), key, top_n)
