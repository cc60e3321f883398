"""Scoring rankings: precision and recall at k, reciprocal rank, macro means.

``recs(query, rank, item)`` with ranks from 1, ``truth(query, item)``, ``queries(query)``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


KS = (1, 5, 10)


def _or_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def precision_at_k(hits: Column, shown: Column) -> Column:
    """Hits over the number of items shown, which may be less than k; nothing shown gives 0."""
    return _or_zero(F.when(shown > 0, hits / shown))


def recall_at_k(hits: Column, relevant: Column) -> Column:
    return _or_zero(F.when(relevant > 0, hits / relevant))


def reciprocal_rank(first_hit: Column) -> Column:
    return _or_zero(1.0 / first_hit)


def per_query_metrics(recs: DataFrame, truth: DataFrame, queries: DataFrame, ks: Sequence[int] = KS) -> DataFrame:
    """One row per query: ``p_at_k``, ``r_at_k`` for each k, and ``mrr``; unknown queries score 0."""
    relevant = truth.select("query", "item").distinct()
    judged = recs.join(relevant.withColumn("hit", F.lit(True)), ["query", "item"], "left")
    hit = F.coalesce("hit", F.lit(False))
    counted = judged.groupBy("query").agg(
        F.min(F.when(hit, F.col("rank"))).alias("first_hit"),
        *[F.count_if(hit & (F.col("rank") <= k)).alias(f"hits_{k}") for k in ks],
        *[F.count_if(F.col("rank") <= k).alias(f"shown_{k}") for k in ks],
    )
    sizes = relevant.groupBy("query").agg(F.count(F.lit(1)).alias("relevant"))
    full = queries.select("query").join(counted, "query", "left").join(sizes, "query", "left")
    return full.select(
        "query",
        *[precision_at_k(F.col(f"hits_{k}"), F.col(f"shown_{k}")).alias(f"p_at_{k}") for k in ks],
        *[recall_at_k(F.col(f"hits_{k}"), F.col("relevant")).alias(f"r_at_{k}") for k in ks],
        reciprocal_rank(F.col("first_hit")).alias("mrr"),
    )


def evaluate(recs: DataFrame, truth: DataFrame, queries: DataFrame, ks: Sequence[int] = KS) -> DataFrame:
    """One row of means over all queries; no queries give zeros."""
    scores = per_query_metrics(recs, truth, queries, ks)
    return scores.agg(*[_or_zero(F.avg(c)).alias(c) for c in scores.columns if c != "query"])


Recommender = Callable[[DataFrame, int], DataFrame]


def evaluate_recommender(recommender: Recommender, queries: DataFrame, truth: DataFrame, ks: Sequence[int] = KS) -> DataFrame:
    """Ask ``recommender(queries, k)`` once for all queries and score what it returns."""
    return evaluate(recommender(queries, max(ks)), truth, queries, ks)
