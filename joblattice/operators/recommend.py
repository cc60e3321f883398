"""Ranking documents for many queries at once by cosine similarity of tf-idf weights."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from joblattice.functions.skills import vocab_skills
from joblattice.operators import tfidf, topk
from joblattice.operators.rows import first_per_key
from joblattice.session import broadcast_if_small, cut_lineage, is_small, written

SCORE = "_similarity_score"
SKILLS = "_extracted_skills"
#: Scores are rounded before ranking, so that equal texts rank the same each time.
DIGITS = 9


def cosine_scores(query_weights: DataFrame, postings: DataFrame, digits: int = 9, small: bool = False) -> DataFrame:
    """``(query_id, doc_id, score)`` of every query and document that share a term.

    ``small`` says that the caller has checked the query side.
    """
    asked = query_weights.select("query_id", tfidf.TERM, F.col("weight").alias("query_weight"))
    met = topk.meet(postings, asked, small)
    products = met.select("query_id", tfidf.DOC, (F.col("query_weight") * F.col("weight")).alias("product"))
    return products.groupBy("query_id", tfidf.DOC).agg(F.round(F.sum("product"), digits).alias(SCORE))


def top_documents(scores: DataFrame, queries: DataFrame, docs: DataFrame, key: str, top_n: int) -> DataFrame:
    """``(query_id, rank, doc_id, score)``: best ``top_n`` per query, ties by smaller id.

    Queries with fewer matches are filled with zero-score documents in id order. Those can only be
    among the ``top_n`` smallest ids of all, so no other unmatched document is looked at.
    """
    order = [F.desc(SCORE), F.asc(tfidf.DOC)]
    best = first_per_key(scores, ["query_id"], order, top_n)
    fill_ids = docs.select(F.col(key).alias("id")).orderBy("id").limit(top_n).agg(F.collect_list("id")).scalar()
    fill = queries.select("query_id", F.explode(fill_ids).alias(tfidf.DOC), F.lit(0.0).alias(SCORE))
    either = best.unionByName(fill).groupBy("query_id", tfidf.DOC).agg(F.max(SCORE).alias(SCORE))
    return _ranked(either, order, top_n)


def _ranked(scores: DataFrame, order: list[Column], top_n: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(*order))
    return scores.withColumn("rank", rank).filter(F.col("rank") <= top_n).select("query_id", "rank", tfidf.DOC, SCORE)


def recommend(
    queries: DataFrame,
    docs: DataFrame,
    key: str = "job_id",
    text: str = "job_description",
    top_n: int = 10,
    model: tfidf.Model | None = None,
    spec: tfidf.Spec = tfidf.STORED,
    lemmas: DataFrame | None = None,
) -> DataFrame:
    """Top ``top_n`` documents for each row of ``queries(query_id, query)``.

    Without a model one is fitted on ``docs`` first. When many products lie behind the join of query and
    document terms, only documents that can be among the best are scored whole (``topk``); the result is
    the same.
    """
    tfidf.need_column(docs, text)
    fresh = model is None
    model = model or tfidf.fit(docs, key, text, spec, lemmas, written_vocab=True)
    asked = tfidf.term_counts(queries, "query_id", "query", model.spec, lemmas)
    small = is_small(asked)
    weights = tfidf.weigh(asked, model.vocab, model.spec).withColumnRenamed(tfidf.DOC, "query_id")
    weights = written(weights, "query-weights")
    if (fresh or model.bounds is not None) and topk.worth_bounding(weights, model.vocab):
        if fresh:
            model = tfidf.placed(docs, key, text, model.vocab, model.spec, lemmas)
        scores = topk.best_scores(weights, model, top_n, DIGITS, small, SCORE)
    else:
        stored = small and model.bounds is not None  # files by frequency band hold a document's terms apart
        postings = topk.by_document(model.postings, weights) if stored else model.postings
        scores = cosine_scores(weights, postings, DIGITS, small)
    return top_documents(scores, queries, docs, key, top_n)


def with_documents(
    ranked: DataFrame,
    docs: DataFrame,
    key: str = "job_id",
    skills_field: str | None = "job_description",
    vocab: Iterable[str] | None = None,
    aliases: dict[str, str] | None = None,
) -> DataFrame:
    """Ranked rows with their document columns; skills are extracted for the ranked rows only."""
    rows = broadcast_if_small(cut_lineage(ranked))
    full = docs.join(rows, docs[key] == rows[tfidf.DOC]).drop(rows[tfidf.DOC]) if key != tfidf.DOC else docs.join(rows, key)
    if skills_field is None or skills_field not in docs.columns:
        return full
    return full.withColumn(SKILLS, vocab_skills(F.col(skills_field), vocab, aliases))
