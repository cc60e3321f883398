"""Exact best documents for many queries without scoring every document that shares a term.

The terms of a query are taken rarest first. Its rare terms alone name some documents; the n-th best
of their whole scores is a floor no smaller score can pass. What the common terms can still add is
bounded twice: each adds at most its query weight times the largest weight it has in any document, and
since a document's weights have length 1, all of them add at most the length of their query weights,
shortened by what the document has already shown. Common terms that cannot reach the floor on their
own are not joined at all; a document goes on only while what is left can lift it to the floor, and the
common terms are joined for those documents alone. Postings lie by frequency band of their term, so
the rounds over rare terms read none of the common ones' files.

Rounds pay only where bounds set a good part of the products aside. Otherwise all products are summed in
one round, each document's in one task, and the floors keep all but the best from being sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from joblattice.operators import tfidf
from joblattice.operators.rows import first_per_key
from joblattice.session import broadcast_if_small, written

#: Scores are compared after rounding; bounds leave that much room.
MARGIN = 1e-8
#: Documents scored whole for the floor, as a multiple of the number asked for.
NOMINEES = 2
#: Products of query and document terms that a core sums up sooner than bounds could spare them.
PLAIN_PRODUCTS = 500_000_000
#: Share of all products behind the terms that bounds cannot set aside, from which on all are summed in one round.
ONE_ROUND_SHARE = 0.5
_SPREAD = 16


def worth_bounding(weights: DataFrame, vocab: DataFrame) -> bool:
    """Whether so many products lie behind the term join that finding bounds first pays."""
    found = weights.join(vocab.select(tfidf.TERM, "df"), tfidf.TERM).agg(F.sum("df")).first()[0]
    return (found or 0) > PLAIN_PRODUCTS * weights.sparkSession.sparkContext.defaultParallelism


def by_document(postings: DataFrame, asked: DataFrame) -> DataFrame:
    """The postings of the queries' terms, a document's in one task, so that its scores are summed where they lie."""
    terms = F.broadcast(asked.select(tfidf.TERM).distinct())
    return postings.select(tfidf.DOC, tfidf.TERM, "weight").join(terms, tfidf.TERM, "left_semi").repartition(F.col(tfidf.DOC))


def meet(postings: DataFrame, asked: DataFrame, small: bool) -> DataFrame:
    """Postings beside the queries' terms, on ``term``.

    With a small query side, as checked by the caller, the postings stay where they are. Otherwise
    both sides meet by term, and a term's documents are spread over ``_SPREAD`` tasks: no term is rare
    enough to be trusted with one.
    """
    if small:
        return postings.join(F.broadcast(asked), tfidf.TERM)
    every = F.explode(F.sequence(F.lit(0), F.lit(_SPREAD - 1))).alias("part")
    part = F.pmod(F.hash(tfidf.DOC), F.lit(_SPREAD))
    return postings.withColumn("part", part).join(asked.select("*", every), [tfidf.TERM, "part"])


def _in_bands(postings: DataFrame, asked: DataFrame) -> DataFrame:
    """The postings of the frequency bands that the terms lie in; there are some thirty bands at most."""
    return postings.filter(F.col("band").isin([r[0] for r in asked.select("band").distinct().collect()]))


def ordered_terms(weights: DataFrame, bounds: DataFrame, top_n: int) -> DataFrame:
    """Query terms rarest first, with what they and all more common ones can add at most.

    ``seed`` marks the terms up to the first that ``top_n`` documents hold.
    """
    terms = weights.select("query_id", tfidf.TERM, F.col("weight").alias("query_weight"))
    terms = terms.join(broadcast_if_small(bounds), tfidf.TERM)
    rarest = Window.partitionBy("query_id").orderBy("df", tfidf.TERM)
    onwards = rarest.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    before = rarest.rowsBetween(Window.unboundedPreceding, -1)
    wide = F.count(F.when(F.col("df") >= top_n, 1)).over(before)
    return terms.withColumns(
        {
            "seed": wide == 0,
            "sum_left": F.sum(F.col("query_weight") * F.col("top")).over(onwards),
            "square_left": F.sum(F.col("query_weight") * F.col("query_weight")).over(onwards),
        }
    )


def _shares(met: DataFrame) -> Column:
    return F.sum(F.col("query_weight") * F.col("weight"))


def floors(postings: DataFrame, asked: DataFrame, top_n: int, small: bool) -> DataFrame:
    """``(query_id, floor)``: the ``top_n``-th best whole score among documents the rare terms name.

    Queries that fewer documents answer have no row.
    """
    seeds = asked.filter("seed")
    met = meet(_in_bands(postings, seeds), seeds.select("query_id", tfidf.TERM, "query_weight"), small)
    partial = met.groupBy("query_id", tfidf.DOC).agg(_shares(met).alias("score"))
    named = first_per_key(partial, ["query_id"], [F.desc("score"), F.asc(tfidf.DOC)], NOMINEES * top_n)
    scored = _completed(postings, written(named.select("query_id", tfidf.DOC), "nominees"), asked, small)
    best = scored.groupBy("query_id").agg(F.sort_array(F.collect_list("score"), asc=False).alias("scores"))  # NOMINEES * top_n
    return best.select("query_id", F.get("scores", F.lit(top_n - 1)).alias("floor")).filter("floor IS NOT NULL")


def _completed(postings: DataFrame, pairs: DataFrame, asked: DataFrame, small: bool) -> DataFrame:
    """``(query_id, doc_id, score)`` of the given written pairs over the given query terms.

    Few pairs read the terms of their documents; where the query terms have fewer rows than those,
    the terms are met instead and what is no pair falls away. Pairs without a term have no row.
    """
    terms = asked.select("query_id", tfidf.TERM, "query_weight")
    n_products, most = asked.agg(F.sum("df"), F.max("df")).first()
    if n_products is None:
        return pairs.limit(0).withColumn("score", F.lit(0.0))
    if pairs.count() * postings.count() / most < n_products:  # at least ``most`` documents share the postings
        held = postings.select(tfidf.DOC, tfidf.TERM, "weight").join(broadcast_if_small(pairs), tfidf.DOC)
        met = held.join(broadcast_if_small(terms), ["query_id", tfidf.TERM])
    else:
        met = meet(_in_bands(postings, asked), terms, small).join(broadcast_if_small(pairs), ["query_id", tfidf.DOC])
    return met.groupBy("query_id", tfidf.DOC).agg(_shares(met).alias("score"))


def _one_round(asked: DataFrame) -> bool:
    """Whether the bounds set so few products aside that rounds over the rest would cost more than they spare."""
    needed, every = asked.agg(F.sum(F.when(F.col("needed"), F.col("df"))), F.sum("df")).first()
    return (needed or 0) > ONE_ROUND_SHARE * (every or 0)


def _best_at_once(asked: DataFrame, floor: DataFrame, model: tfidf.Model, digits: int, name: str) -> DataFrame:
    """The scores that reach the floors, each summed in the task of its document."""
    terms = asked.select("query_id", tfidf.TERM, "query_weight")
    met = by_document(model.postings, terms).join(F.broadcast(terms), tfidf.TERM)
    scores = met.groupBy("query_id", tfidf.DOC).agg(_shares(met).alias("score"))
    best = scores.join(broadcast_if_small(floor), "query_id", "left")
    best = best.filter(F.col("floor").isNull() | (F.col("score") >= F.col("floor") - MARGIN))
    return best.select("query_id", tfidf.DOC, F.round("score", digits).alias(name))


def best_scores(weights: DataFrame, model: tfidf.Model, top_n: int, digits: int, small: bool, name: str) -> DataFrame:
    """``(query_id, doc_id, score)``: exact scores of all documents that may be among a query's best ``top_n``."""
    asked = written(ordered_terms(weights, model.bounds, top_n), "query-terms")
    floor = written(floors(model.postings, asked, top_n, small), "query-floors")
    asked = asked.join(broadcast_if_small(floor), "query_id", "left")
    reach = F.least("sum_left", F.sqrt("square_left"))
    needed = F.col("floor").isNull() | (reach >= F.col("floor") - MARGIN)
    asked = written(asked.withColumn("needed", needed), "query-terms")

    if small and _one_round(asked):
        return _best_at_once(asked, floor, model, digits, name)
    rare, common = asked.filter("needed"), asked.filter("NOT needed")
    left = common.groupBy("query_id").agg(F.max("sum_left").alias("sum_left"), F.max("square_left").alias("square_left"))
    left = floor.join(left, "query_id", "left").na.fill(0.0, ["sum_left", "square_left"])
    met = meet(_in_bands(model.postings, rare), rare.select("query_id", tfidf.TERM, "query_weight"), small)
    partial = met.groupBy("query_id", tfidf.DOC).agg(
        _shares(met).alias("partial"), F.sum(F.col("weight") * F.col("weight")).alias("shown")
    )
    rest = F.sqrt(F.col("square_left") * F.greatest(F.lit(0.0), 1 - F.col("shown") + MARGIN))
    reach = F.col("partial") + F.least("sum_left", rest)
    alive = partial.join(broadcast_if_small(left), "query_id", "left")
    alive = alive.filter(F.col("floor").isNull() | (reach >= F.col("floor") - MARGIN))
    alive = written(alive.select("query_id", tfidf.DOC, "partial"), "query-survivors")

    added = _completed(model.postings, alive.select("query_id", tfidf.DOC), common, small)
    parts = alive.withColumnRenamed("partial", "score").unionByName(added)
    return parts.groupBy("query_id", tfidf.DOC).agg(F.round(F.sum("score"), digits).alias(name))
