"""Queries of term models, recommendations, their scores, and trigram search."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from joblattice.operators import evaluate, recommend, search, tfidf, topk
from joblattice.plans.catalog import Tables, query, sql_skill_tokens, sql_word_tokens
from joblattice.plans.text_queries import VOCAB
from joblattice.session import broadcast_if_small, is_small, scratch_path, written
from joblattice.sources import models

# --- SQL pieces ---------------------------------------------------------------------------------------


def _grams(source: str, bigrams: bool = True, stop: str = "") -> str:
    two = "UNION ALL SELECT id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words" if bigrams else ""
    words = sql_word_tokens("text")
    if stop:
        words = f"list_filter({words}, lambda x: NOT list_contains({stop}, x))"
    return f"""
        WITH words AS (SELECT id, {words} AS w FROM ({source})),
        grams AS (SELECT id, unnest(w) AS term FROM words {two})
        SELECT id, term, count(*) AS tf FROM grams GROUP BY id, term"""


def _model(docs: str, max_features: int | None = 10000, bigrams: bool = True, stop: str = "", tf: str = "tf", keep: str = "true") -> str:
    cut = "" if max_features is None else f"ORDER BY cf DESC, term LIMIT {max_features}"
    return f"""
counts AS ({_grams(docs, bigrams, stop)}),
size AS (SELECT count(*) AS n FROM ({docs})),
totals AS (SELECT term, CAST(sum(tf) AS BIGINT) AS cf, count(*) AS df FROM counts GROUP BY term),
vocab AS (SELECT term, cf, df, ln((1 + n) / (1 + df)) + 1 AS idf FROM totals, size WHERE {keep} {cut}),
raw AS (SELECT id, term, ({tf}) * idf AS raw FROM counts JOIN vocab USING (term)),
postings AS (SELECT id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY id)) AS weight FROM raw)"""


_DOCS = "SELECT doc_id AS id, text FROM documents"


def _ranked(bigrams: bool = True, max_features: int | None = 10000) -> str:
    return f"""{_model(_DOCS, max_features, bigrams)},
qcounts AS ({_grams('SELECT item_id AS id, text FROM benchmark', bigrams)}),
qraw AS (SELECT id, term, tf * idf AS raw FROM qcounts JOIN vocab USING (term)),
qweights AS (SELECT id AS query_id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY id)) AS qw FROM qraw),
scores AS (SELECT query_id, id AS doc_id, round(sum(qw * weight), 9) AS score FROM qweights JOIN postings USING (term) GROUP BY ALL),
all_scores AS (SELECT item_id AS query_id, d.doc_id, coalesce(score, 0.0) AS score
    FROM benchmark CROSS JOIN documents d LEFT JOIN scores s ON s.query_id = item_id AND s.doc_id = d.doc_id),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM all_scores),
recs AS (SELECT query_id, rank, doc_id, score FROM ranked WHERE rank <= 10)"""


def _queries(t: Tables) -> DataFrame:
    return t.benchmark.select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))


# --- term models ----------------------------------------------------------------------------------------


@query(f"WITH {_model(_DOCS)} SELECT term, cf, df, round(idf, 6) AS idf FROM vocab")
def tfidf_vocab(t: Tables) -> DataFrame:
    vocab = tfidf.vocabulary(t.documents, "doc_id", "text")
    return vocab.select("term", "cf", "df", F.round("idf", 6).alias("idf"))


@query(f"WITH {_model(_DOCS, None, False)} SELECT term, df, row_number() OVER (ORDER BY term) - 1 AS term_id FROM vocab")
def tfidf_term_ids(t: Tables) -> DataFrame:
    """The numbers of all terms of an uncut vocabulary, dealt by ranges."""
    vocab = tfidf.with_term_ids(tfidf.vocabulary(t.documents, "doc_id", "text", tfidf.ON_THE_FLY))
    return vocab.select("term", "df", "term_id")


@query(f"WITH {_model(_DOCS)} SELECT id AS doc_id, term, round(weight, 6) AS weight FROM postings")
def tfidf_weights(t: Tables) -> DataFrame:
    postings = tfidf.fit(t.documents, "doc_id", "text", written_vocab=True).postings
    return postings.select("doc_id", "term", F.round("weight", 6).alias("weight"))


_OPTIONS = tfidf.Spec(
    max_features=2000, ngram_range=(1, 2), min_df=2, max_df=0.4, sublinear_tf=True, stopwords=("the", "of", "de")
)


@query(f"""WITH {_model(_DOCS, 2000, True, "['the', 'of', 'de']", 'ln(tf) + 1', 'df >= 2 AND df <= 0.4 * n')}
SELECT id AS doc_id, term, round(weight, 6) AS weight FROM postings""")
def tfidf_options(t: Tables) -> DataFrame:
    postings = tfidf.fit(t.documents, "doc_id", "text", _OPTIONS, written_vocab=True).postings
    return postings.select("doc_id", "term", F.round("weight", 6).alias("weight"))


_CHANGED = "SELECT doc_id AS id, CASE WHEN quality = 1 THEN text || ' freshly edited' ELSE text END AS text FROM documents LEFT JOIN labels USING (doc_id)"


def _edited(t: Tables) -> tuple[DataFrame, DataFrame]:
    """All documents, and the well-labelled ones with words added."""
    docs = t.documents.select("doc_id", "text")
    edited = docs.join(t.labels.filter(F.col("quality") == 1).select("doc_id"), "doc_id")
    return docs, edited.withColumn("text", F.concat("text", F.lit(" freshly edited")))


@query(f"WITH {_model(_CHANGED)} SELECT id AS doc_id, term, round(weight, 6) AS weight FROM postings")
def tfidf_incremental(t: Tables) -> DataFrame:
    """Model of the documents, brought up to date after the well-labelled ones were edited."""
    spec = tfidf.STORED
    docs, edited = _edited(t)
    held = written(tfidf.word_lists(docs, "doc_id", "text", spec), "words")
    changed = written(tfidf.word_lists(edited, "doc_id", "text", spec), "words")
    kept = tfidf.frequent_buckets(tfidf.replace_counts(held, changed, tfidf.DOC, changed), tfidf.count_docs(docs), spec)
    stored, fresh = tfidf.list_counts(held, spec, kept), tfidf.list_counts(changed, spec, kept)
    counts = tfidf.replace_counts(stored, changed, tfidf.DOC, fresh)
    totals = tfidf.shift_totals(tfidf.corpus_counts(stored), stored, changed, tfidf.DOC, fresh)
    postings = tfidf.from_counts(counts, totals, tfidf.count_docs(docs), spec).postings
    return postings.select("doc_id", "term", F.round("weight", 6).alias("weight"))


@query(f"WITH {_model(_DOCS)} SELECT count(*) AS vocab_size, '(1, 2)' AS ngram_range FROM vocab")
def model_summary(t: Tables) -> DataFrame:
    return models.summary(tfidf.fit(t.documents, "doc_id", "text", written_vocab=True))


@query(f"""WITH {_model(_CHANGED)}, numbered AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS term_id FROM vocab)
SELECT id AS doc_id, term, CAST(term_id AS INTEGER) AS term_id, round(weight, 6) AS weight FROM postings JOIN numbered USING (term)""")
def model_stored(t: Tables) -> DataFrame:
    """A model written down, brought to a second version with the edited documents, and loaded."""
    spec = tfidf.STORED
    root, docs, edited = scratch_path(t.spark, "models"), *_edited(t)
    models.build_and_save(docs, "doc_id", "text", root, "v1", spec)
    models.update_and_save(docs, edited, "doc_id", "text", root, "v1", "v2", spec)
    model = models.load(t.spark, root, "v2", spec)
    numbered = model.postings.join(model.vocab.select("term", "term_id"), "term")
    return numbered.select("doc_id", "term", "term_id", F.round("weight", 6).alias("weight"))


# --- recommendations --------------------------------------------------------------------------------------


def _shown(ranked: DataFrame) -> DataFrame:
    return ranked.withColumn(recommend.SCORE, F.round(recommend.SCORE, 6))


@query(f"WITH {_ranked()} SELECT query_id, rank, doc_id, round(score, 6) AS _similarity_score FROM recs")
def recommend_topk(t: Tables) -> DataFrame:
    return _shown(recommend.recommend(_queries(t), t.documents, "doc_id", "text"))


@query(f"WITH {_ranked(False, None)} SELECT query_id, rank, doc_id, round(score, 6) AS _similarity_score FROM recs")
def recommend_unigrams(t: Tables) -> DataFrame:
    return _shown(recommend.recommend(_queries(t), t.documents, "doc_id", "text", spec=tfidf.ON_THE_FLY))


@query(f"WITH {_ranked()} SELECT query_id, rank, doc_id, round(score, 6) AS _similarity_score FROM recs")
def recommend_bounded(t: Tables) -> DataFrame:
    """The ranking of ``recommend_topk`` from bounds, whatever the number of products."""
    vocab = written(tfidf.vocabulary(t.documents, "doc_id", "text"), "vocabulary")
    model = tfidf.placed(t.documents, "doc_id", "text", vocab)
    asked = tfidf.transform(_queries(t), "query_id", "query", vocab).withColumnRenamed("doc_id", "query_id")
    scores = topk.best_scores(written(asked, "query-weights"), model, 10, recommend.DIGITS, is_small(asked), recommend.SCORE)
    return _shown(recommend.top_documents(scores, _queries(t), t.documents, "doc_id", 10))


@query(f"WITH {_ranked(False, None)} SELECT query_id, rank, doc_id, round(score, 6) AS _similarity_score FROM recs")
def recommend_stored(t: Tables) -> DataFrame:
    """Ranking from a stored model that brings its own settings along."""
    root = scratch_path(t.spark, "ranked-models")
    models.build_and_save(t.documents, "doc_id", "text", root, "v1", tfidf.ON_THE_FLY)
    return _shown(recommend.recommend(_queries(t), t.documents, "doc_id", "text", model=models.load(t.spark, root, "v1")))


@query(f"""WITH {_ranked()}
SELECT query_id, rank, doc_id, source, round(score, 6) AS _similarity_score,
    array_to_string(list_sort(list_distinct(list_filter({sql_skill_tokens('text')}, lambda w: list_contains({VOCAB!r}, w)))), ', ') AS skills
FROM recs JOIN documents USING (doc_id)""")
def recommend_skills(t: Tables) -> DataFrame:
    ranked = recommend.recommend(_queries(t), t.documents, "doc_id", "text")
    full = recommend.with_documents(ranked, t.documents, "doc_id", "text", VOCAB, {})
    shown = F.array_join(recommend.SKILLS, ", ").alias("skills")
    return _shown(full).select("query_id", "rank", "doc_id", "source", recommend.SCORE, shown)


# --- scores of rankings: a document is relevant when it holds a query's most specific term -------------------

_TRUTH = """
specific AS (SELECT query_id, arg_min(term, (df, term)) AS term FROM qweights JOIN vocab USING (term) GROUP BY query_id),
truth AS (SELECT query_id AS query, id AS item FROM specific JOIN counts USING (term)),
judged AS (SELECT r.query_id AS query, r.rank, t.item IS NOT NULL AS hit FROM recs r LEFT JOIN truth t ON t.query = r.query_id AND t.item = r.doc_id),
relevant AS (SELECT query, count(*) AS n FROM truth GROUP BY query),
scored AS (SELECT item_id AS query,
    coalesce(avg(hit::INT) FILTER (WHERE rank <= 1), 0) AS p_at_1, coalesce(avg(hit::INT) FILTER (WHERE rank <= 5), 0) AS p_at_5,
    coalesce(avg(hit::INT) FILTER (WHERE rank <= 10), 0) AS p_at_10,
    coalesce(sum(hit::INT) FILTER (WHERE rank <= 1) / any_value(n), 0) AS r_at_1,
    coalesce(sum(hit::INT) FILTER (WHERE rank <= 5) / any_value(n), 0) AS r_at_5,
    coalesce(sum(hit::INT) FILTER (WHERE rank <= 10) / any_value(n), 0) AS r_at_10,
    coalesce(1.0::DOUBLE / min(rank) FILTER (WHERE hit), 0) AS mrr
    FROM benchmark LEFT JOIN judged ON judged.query = item_id LEFT JOIN relevant ON relevant.query = item_id GROUP BY item_id)"""
_METRICS = ["p_at_1", "p_at_5", "p_at_10", "r_at_1", "r_at_5", "r_at_10", "mrr"]


def _truth(queries: DataFrame, model: tfidf.Model) -> DataFrame:
    asked = tfidf.term_counts(queries, "query_id", "query", model.spec).join(model.vocab.select("term", "df"), "term")
    specific = asked.groupBy("doc_id").agg(F.min_by("term", F.struct("df", "term")).alias("term"))
    named = broadcast_if_small(specific.withColumnRenamed("doc_id", "query"))
    held = model.postings.select(F.col("doc_id").alias("item"), "term")
    return held.join(named, "term").select("query", "item")


def _evaluated(t: Tables, score) -> DataFrame:
    queries, docs = _queries(t), t.documents
    vocab = written(tfidf.vocabulary(docs, "doc_id", "text"), "vocabulary")
    model = tfidf.placed(docs, "doc_id", "text", vocab)

    def by_tfidf(asked: DataFrame, k: int) -> DataFrame:
        named = asked.withColumnRenamed("query", "query_id").join(queries, "query_id")
        ranked = recommend.recommend(named, docs, "doc_id", "text", k, model)
        return ranked.withColumnsRenamed({"query_id": "query", "doc_id": "item"})

    ids = queries.select(F.col("query_id").alias("query"))
    scores = score(by_tfidf, ids, _truth(queries, model))
    return scores.withColumns({m: F.round(m, 6) for m in _METRICS})


@query(f"WITH {_ranked()}, {_TRUTH} SELECT {', '.join(f'round(avg({m}), 6) AS {m}' for m in _METRICS)} FROM scored")
def eval_metrics(t: Tables) -> DataFrame:
    return _evaluated(t, evaluate.evaluate_recommender)


@query(f"WITH {_ranked()}, {_TRUTH} SELECT query, {', '.join(f'round({m}, 6) AS {m}' for m in _METRICS)} FROM scored")
def eval_per_query(t: Tables) -> DataFrame:
    return _evaluated(t, lambda fn, ids, truth: evaluate.per_query_metrics(fn(ids, 10), truth, ids))


@query("""
WITH sold AS (SELECT s_nationkey AS query, l_partkey AS item, sum(l_quantity) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
    WHERE l_shipdate < TIMESTAMP '1999-01-01' GROUP BY ALL),
recs AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY n DESC, item) AS rank FROM sold QUALIFY rank <= 10),
truth AS (SELECT DISTINCT s_nationkey AS query, l_partkey AS item FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
    WHERE l_shipdate >= TIMESTAMP '1999-01-01'),
relevant AS (SELECT query, count(*) AS n FROM truth GROUP BY query),
judged AS (SELECT r.query, r.rank, t.item IS NOT NULL AS hit FROM recs r LEFT JOIN truth t USING (query, item)),
scored AS (SELECT n_nationkey,
    coalesce(avg(hit::INT) FILTER (WHERE rank <= 1), 0) AS p1, coalesce(avg(hit::INT) FILTER (WHERE rank <= 10), 0) AS p10,
    coalesce(sum(hit::INT) FILTER (WHERE rank <= 10) / any_value(n), 0) AS r10, coalesce(1.0::DOUBLE / min(rank) FILTER (WHERE hit), 0) AS rr
    FROM nation LEFT JOIN judged ON judged.query = n_nationkey LEFT JOIN relevant ON relevant.query = n_nationkey GROUP BY n_nationkey)
SELECT round(avg(p1), 6) AS p_at_1, round(avg(p10), 6) AS p_at_10, round(avg(r10), 6) AS r_at_10, round(avg(rr), 6) AS mrr FROM scored""")
def eval_best_sellers(t: Tables) -> DataFrame:
    """Another recommender in the same frame: a nation's best-selling parts, judged by its later sales."""
    sold = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    early = F.col("l_shipdate") < F.lit("1999-01-01").cast("timestamp_ntz")
    named = [F.col("s_nationkey").alias("query"), F.col("l_partkey").alias("item")]

    def best_sellers(asked: DataFrame, k: int) -> DataFrame:
        totals = sold.filter(early).groupBy(*named).agg(F.sum("l_quantity").alias("n"))
        rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("n"), "item"))
        return totals.withColumn("rank", rank).filter(F.col("rank") <= k).join(asked, "query")

    nations = t.nation.select(F.col("n_nationkey").alias("query"))
    scores = evaluate.evaluate_recommender(best_sellers, nations, sold.filter(~early).select(*named).distinct(), (1, 10))
    return scores.select(*[F.round(m, 6).alias(m) for m in ("p_at_1", "p_at_10", "r_at_10", "mrr")])


# --- trigram search ------------------------------------------------------------------------------------------


def _sql_trigrams(column: str) -> str:
    padded = "'  ' || w || ' '"
    return (
        f"list_distinct(flatten(list_transform(list_distinct(regexp_extract_all(lower({column}), '[\\p{{L}}\\p{{N}}]+')), "
        f"lambda w: list_transform(range(1, len(w) + 2), lambda i: substr({padded}, i, 3)))))"
    )


@query(f"""
WITH sets AS (SELECT p_partkey, p_name, {_sql_trigrams('p_name')} AS a, {_sql_trigrams("'small ringg'")} AS b FROM part),
scored AS (SELECT p_partkey, p_name, len(list_intersect(a, b)) / (len(a) + len(b) - len(list_intersect(a, b))) AS similarity FROM sets)
SELECT p_partkey, p_name, round(similarity, 6) AS similarity FROM scored WHERE similarity >= 0.3 ORDER BY scored.similarity DESC, p_partkey LIMIT 20""")
def fuzzy_search(t: Tables) -> DataFrame:
    found = search.fuzzy_search(t.part, "p_partkey", "p_name", "small ringg")
    return found.select("p_partkey", "p_name", F.round("similarity", 6).alias("similarity"))


def _sql_gram_rows(table: str, key: str) -> str:
    words = f"SELECT DISTINCT {key}, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+')) AS w FROM {table}"
    return f"SELECT DISTINCT {key}, unnest(list_transform(range(1, len(w) + 2), lambda i: substr('  ' || w || ' ', i, 3))) AS gram FROM ({words})"


_FUZZY_SQL = f"""
WITH asked AS ({_sql_gram_rows('benchmark', 'item_id')}), held AS ({_sql_gram_rows('documents', 'doc_id')}),
asked_size AS (SELECT item_id, count(*) AS qn FROM asked GROUP BY item_id), held_size AS (SELECT doc_id, count(*) AS dn FROM held GROUP BY doc_id),
common AS (SELECT item_id, doc_id, count(*) AS shared FROM asked JOIN held USING (gram) GROUP BY ALL),
scored AS (SELECT item_id AS query_id, doc_id, shared / (qn + dn - shared) AS similarity FROM common JOIN asked_size USING (item_id) JOIN held_size USING (doc_id)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, doc_id) AS n FROM scored WHERE similarity >= 0.3)
SELECT query_id, doc_id, round(similarity, 6) AS similarity FROM ranked WHERE n <= 20"""


@query(_FUZZY_SQL)
def fuzzy_search_many(t: Tables) -> DataFrame:
    found = search.fuzzy_search_many(t.documents, "doc_id", "text", _queries(t))
    return found.select("query_id", "doc_id", F.round("similarity", 6).alias("similarity"))


@query(_FUZZY_SQL)
def fuzzy_search_indexed(t: Tables) -> DataFrame:
    """The same search from a written trigram index."""
    path = scratch_path(t.spark, "trigram-index")
    search.write_index(t.documents, "doc_id", "text", path)
    found = search.fuzzy_search_indexed(t.spark, path, "doc_id", _queries(t))
    return found.select("query_id", "doc_id", F.round("similarity", 6).alias("similarity"))
