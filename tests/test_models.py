from __future__ import annotations

import math
import os
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from joblattice import session
from joblattice.operators import counting, evaluate, recommend, search, tfidf, topk
from joblattice.plans import catalog
from joblattice.sources import models


def some_docs(n=60, seed=2):
    rng = random.Random(seed)
    words = ["data", "python", "sql", "cloud", "team", "paris", "senior", "etl", "a", "x1y", "été"]
    docs = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 12))) for _ in range(n)]
    # A third of all documents are one text.
    return [("data python sql data" if i % 3 == 0 else d) for i, d in enumerate(docs)] + ["", None]


def words_of(text):
    kept = "".join(ch if "a" <= ch <= "z" else " " for ch in (text or "").lower())
    return [w for w in kept.split() if len(w) >= 2]


def grams_of(text, high=2, stop=()):
    w = [x for x in words_of(text) if x not in stop]
    return Counter(w + ([" ".join(p) for p in zip(w, w[1:])] if high == 2 else []))


def plain_model(texts, spec):
    tf = [grams_of(t, spec.ngram_range[1], spec.stopwords) for t in texts]
    cf, df = Counter(), Counter()
    for counts in tf:
        cf.update(counts)
        df.update(counts.keys())
    n = len(texts)
    low = spec.min_df if isinstance(spec.min_df, int) else spec.min_df * n
    high = spec.max_df if isinstance(spec.max_df, int) else spec.max_df * n
    terms = sorted((t for t in cf if low <= df[t] <= high), key=lambda t: (-cf[t], t))[: spec.max_features]
    idf = {t: math.log((1 + n) / (1 + df[t])) + 1 for t in terms}
    return idf, [unit(counts, idf, spec) for counts in tf]


def unit(counts, idf, spec):
    raw = {t: ((1 + math.log(c)) if spec.sublinear_tf else c) * idf[t] for t, c in counts.items() if t in idf}
    norm = math.sqrt(sum(v * v for v in raw.values()))
    return {t: v / norm for t, v in raw.items()}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(some_docs())), "job_id long, job_description string").repartition(5)


SPECS = [
    tfidf.STORED,
    tfidf.ON_THE_FLY,
    tfidf.Spec(max_features=9),
    tfidf.Spec(min_df=2, max_df=0.5, sublinear_tf=True, stopwords=("python",)),
    tfidf.Spec(ngram_range=(1, 1), min_df=0.1, max_df=20),
]


@pytest.mark.parametrize("spec", SPECS, ids=range(len(SPECS)))
def test_model_like_plain_counting(docs, spec):
    idf, vectors = plain_model(some_docs(), spec)
    model = tfidf.fit(docs, "job_id", "job_description", spec)
    assert {r["term"]: r["idf"] for r in model.vocab.collect()} == pytest.approx(idf)
    got = defaultdict(dict)
    for r in model.postings.collect():
        got[r["doc_id"]][r["term"]] = r["weight"]
    assert sorted(got) == [i for i, v in enumerate(vectors) if v]
    for i, vector in enumerate(vectors):
        assert got.get(i, {}) == pytest.approx(vector)


def test_empty_corpus_gives_empty_tables(spark):
    empty = spark.createDataFrame([(1, ""), (2, None)], "job_id int, job_description string")
    model = tfidf.fit(empty, "job_id", "job_description")
    assert model.vocab.count() == 0 and model.postings.count() == 0


@pytest.mark.parametrize("key", ["job_id", "doc_id"])
def test_a_plan_splits_each_text_once_and_never_moves_it(spark, docs, folder, key):
    docs.withColumnRenamed("job_id", key).repartition(8).write.parquet(f"{folder}/docs")
    stored = spark.read.parquet(f"{folder}/docs").repartition(8)  # no fewer tasks than cores: nothing to spread
    postings = tfidf.fit(stored, key, "job_description").postings
    postings.collect()
    plan = postings._jdf.queryExecution().executedPlan().toString()
    shared = [line for line in plan.splitlines() if "ReusedExchange" in line and "REPARTITION_BY_COL" in line]
    assert len(shared) == 1 and "counts" in shared[0] and "text" not in shared[0]
    final = plan.split("Initial Plan")[0]
    assert len([line for line in final.splitlines() if "regexp_extract_all" in line]) == 1
    assert len([line for line in final.splitlines() if "Exchange hashpartitioning(doc_id" in line]) == 1

    vocab = tfidf.vocabulary(stored, key, "job_description")
    assert "hashpartitioning(doc_id" not in vocab._jdf.queryExecution().executedPlan().toString()


def test_few_huge_row_groups_are_spread_over_the_cores(spark, docs):
    assert session.spread(docs.coalesce(1)).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = docs.repartition(9)
    assert session.spread(many) is many


@pytest.mark.parametrize("low, high", [(1, 1), (1, 2), (2, 3), (1, 5)])
@pytest.mark.parametrize("chunk", [7, 1 << 19])
def test_counting_in_chunks(spark, monkeypatch, low, high, chunk):
    """Against plain counting, with repeated and null keys, texts longer than a chunk, and arrays as well as rows."""
    monkeypatch.setattr(counting, "CHUNK_WORDS", chunk)
    texts = some_docs()
    keyed = [(None if i == 5 else i // 2, text) for i, text in enumerate(texts)]
    docs = spark.createDataFrame(keyed, "doc_id long, text string").repartition(3)
    spec = tfidf.Spec(ngram_range=(low, high))
    want, corpus = [], defaultdict(lambda: [0, 0])
    for key, text in keyed:
        w = words_of(text)
        tf = Counter(" ".join(w[i : i + n]) for n in range(low, high + 1) for i in range(len(w) - n + 1))
        want += [(key, term, n) for term, n in tf.items()]
        for term, n in tf.items():
            corpus[term][0] += n
            corpus[term][1] += 1
    order = lambda rows: sorted(rows, key=str)
    for placed in (False, True):
        assert order(tuple(r) for r in tfidf.term_counts(docs, "doc_id", "text", spec, placed=placed).collect()) == order(want)
    totals = counting.totals(tfidf.word_lists(docs, "doc_id", "text", spec), low, high)
    assert {r["term"]: [r["cf"], r["df"]] for r in totals.collect()} == corpus


def test_a_lemma_with_a_blank_equals_a_pair(spark):
    docs = spark.createDataFrame([(1, "ny new york"), (2, "new york")], "id int, text string")
    lemmas = spark.createDataFrame([("ny", "new york")], "form string, lemma string")
    counts = {(r["doc_id"], r["term"]): r["tf"] for r in tfidf.term_counts(docs, "id", "text", lemmas=lemmas).collect()}
    assert counts[1, "new york"] == 2 and counts[2, "new york"] == 1 and counts[1, "new york new"] == 1
    facts = {r["term"]: (r["cf"], r["df"]) for r in tfidf.vocabulary(docs, "id", "text", lemmas=lemmas).collect()}
    assert facts["new york"] == (3, 2)


def _rare_term_docs():
    rng = random.Random(5)
    often = ["every", "other", "third"]
    name = lambda i: "".join(chr(97 + int(d)) for d in f"{i:06d}")
    return [(i, " ".join(["every"] * 2 + rng.sample(often, 2) + [name(7 * i), name(7 * i + 1)])) for i in range(300)]


@pytest.mark.parametrize("bits", [20, 3])
@pytest.mark.parametrize("bounds", [{}, {"min_df": 2, "max_df": 0.9}])
def test_rare_terms_are_not_summed_for_a_cut(spark, monkeypatch, bits, bounds):
    """Also with so few buckets that the first floor is far above every count."""
    monkeypatch.setattr(counting, "BUCKETS", 1 << bits)
    monkeypatch.setattr(counting, "_DOWN", counting.np.uint64(64 - bits))
    rows = _rare_term_docs()
    docs = spark.createDataFrame(rows, "job_id long, job_description string")
    spec = tfidf.Spec(max_features=3, **bounds)
    idf, _ = plain_model([text for _, text in rows], spec)
    vocab = tfidf.vocabulary(docs, "job_id", "job_description", spec)
    assert {r["term"]: r["idf"] for r in vocab.collect()} == pytest.approx(idf)
    lists = tfidf.word_lists(docs, "job_id", "job_description", spec)
    kept, floor, totals = tfidf._sums_to_cut(lists, tfidf.count_docs(docs), spec)
    assert floor > 1 and kept is not None
    if bits == 20:
        assert totals.count() < 20 < counting.totals(lists, 1, 2).count()
    assert set(idf) <= {r["term"] for r in totals.collect()}
    whole = tfidf.fit(docs, "job_id", "job_description", spec, written_vocab=True)
    by_term = lambda m: {(r["doc_id"], r["term"]): r["weight"] for r in m.postings.collect()}
    assert by_term(whole) == pytest.approx(by_term(tfidf.fit(docs, "job_id", "job_description", spec)))


@pytest.mark.parametrize("name", ["tfidf_weights", "tfidf_options", "model_summary"])
def test_queries_move_only_terms_of_the_vocabulary(spark, folder, name):
    rows = [(i, text) for i, text in _rare_term_docs()]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    found = catalog.load()[name].build(catalog.Tables(spark, folder))
    assert found.count() > 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "counts" not in plan and "REPARTITION_BY_COL" not in plan


def test_changed_documents_under_a_cut(spark):
    """Only terms that may be among the most frequent after the change are counted, before and after it."""
    rows = _rare_term_docs()
    spec = tfidf.Spec(max_features=3)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    edited = spark.createDataFrame([(i, "fresh " * 5) for i in range(200)] + [(7777, "every fresh"), (299, "")], "doc_id long, text string")
    after = docs.join(edited, "doc_id", "left_anti").unionByName(edited)
    held, changed = (tfidf.word_lists(df, "doc_id", "text", spec) for df in (docs, edited))
    kept = tfidf.frequent_buckets(tfidf.replace_counts(held, changed, tfidf.DOC, changed), tfidf.count_docs(after), spec)
    stored, fresh = tfidf.list_counts(held, spec, kept), tfidf.list_counts(changed, spec, kept)
    assert stored.select("term").distinct().count() < 20
    counts = tfidf.replace_counts(stored, changed, tfidf.DOC, fresh)
    totals = tfidf.shift_totals(tfidf.corpus_counts(stored), stored, changed, tfidf.DOC, fresh)
    model = tfidf.from_counts(counts, totals, tfidf.count_docs(after), spec)
    by_term = lambda m: {(r["doc_id"], r["term"]): r["weight"] for r in m.postings.collect()}
    assert by_term(model) == pytest.approx(by_term(tfidf.fit(after, "doc_id", "text", spec)))


def test_numbers_are_moved_in_place_of_terms(spark, docs, folder):
    spec = tfidf.Spec(max_features=15)
    vocab = tfidf.with_term_ids(tfidf.vocabulary(docs, "job_id", "job_description", spec))
    counts = tfidf.term_counts(docs, "job_id", "job_description", spec)
    numbered, plain = (tfidf.weigh(counts, v, spec) for v in (session.written(vocab, "numbered"), vocab.drop("term_id")))
    by_term = lambda df: {(r["doc_id"], r["term"]): r["weight"] for r in df.collect()}
    assert by_term(numbered) == pytest.approx(by_term(plain))
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") and "REPARTITION_BY_COL" in plan
    models.build_and_save(docs, "job_id", "job_description", folder, "v1", spec)
    models.update_and_save(docs, docs.filter("job_id < 5"), "job_id", "job_description", folder, "v1", "v2", spec)
    assert sorted(os.listdir(folder)) == ["bounds", "postings", "spec", "vocab", "words"]


QUERIES = {1: "senior data python", 2: "sql cloud", 3: "nothing known", 4: "", 5: "etl paris etl"}


def plain_ranking(texts, spec, query, n):
    idf, vectors = plain_model(texts, spec)
    q = unit(grams_of(query, spec.ngram_range[1]), idf, spec)
    scores = [(-round(sum(w * v.get(t, 0.0) for t, w in q.items()), 9), i) for i, v in enumerate(vectors)]
    return [(i, -s) for s, i in sorted(scores)[:n]]


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("top_n", [3, 50])
@pytest.mark.parametrize("bounded", [True, False])
def test_ranking_like_scoring_every_document(spark, docs, monkeypatch, small, top_n, bounded):
    if not small:
        monkeypatch.setattr(recommend, "is_small", lambda *_: False)
    monkeypatch.setattr(topk, "worth_bounding", lambda *_: bounded)
    asked = spark.createDataFrame(list(QUERIES.items()), "query_id int, query string")
    out = recommend.recommend(asked, docs, top_n=top_n).orderBy("query_id", "rank").collect()
    for query_id, query in QUERIES.items():
        expected = plain_ranking(some_docs(), tfidf.STORED, query, top_n)
        got = [(r["doc_id"], r[recommend.SCORE]) for r in out if r["query_id"] == query_id]
        assert [i for i, _ in got] == [i for i, _ in expected]
        assert [s for _, s in got] == pytest.approx([s for _, s in expected], abs=1e-8)
        assert all(0.0 <= s <= 1.0 + 1e-9 for _, s in got)


def _common_term_docs(n=400, seed=6):
    """One term in every document, some in many, and rare ones."""
    rng = random.Random(seed)
    rare = [a + b for a in "klmnp" for b in ("ova", "eri", "uto", "ist", "ond", "arg")]
    mid = ["alpha", "beta", "gamma", "delta"]
    return [" ".join(["every"] * rng.randint(1, 3) + rng.sample(mid, 2) + rng.choices(rare, k=rng.randint(0, 6))) for _ in range(n)]


def test_bounds_spare_the_rows_of_common_terms(spark, monkeypatch):
    texts = _common_term_docs()
    docs = spark.createDataFrame(list(enumerate(texts)), "job_id long, job_description string").repartition(3)
    asked = {1: "every kova kova meri", 2: "every alpha luto pist pist", 3: "every", 4: "every nond narg beta keri", 5: "zzz"}
    queries = spark.createDataFrame(list(asked.items()), "query_id int, query string")
    spec = tfidf.Spec(ngram_range=(1, 1))
    vocab = session.written(tfidf.vocabulary(docs, "job_id", "job_description", spec), "vocabulary")
    model = tfidf.placed(docs, "job_id", "job_description", vocab, spec)
    weights = session.written(tfidf.transform(queries, "query_id", "query", vocab, spec).withColumnRenamed("doc_id", "query_id"), "weights")
    others = F.col("query_id") != 3  # the query of nothing but the term in every document reads all its rows
    before = model.postings.join(weights.select("query_id", "term"), "term").filter(others).count()

    met, real = [], topk.meet
    monkeypatch.setattr(topk, "meet", lambda *a: met.append(real(*a)) or met[-1])
    scores = topk.best_scores(weights, model, 5, 9, True, recommend.SCORE)
    got = recommend.top_documents(scores, queries, docs, "job_id", 5).orderBy("query_id", "rank").collect()
    after = sum(m.filter(others).count() for m in met)
    assert after < before / 4
    assert scores.count() < 0.3 * len(texts) * 3 + len(texts)  # all documents only for the query of the one common term
    for query_id, query in asked.items():
        expected = plain_ranking(texts, spec, query, 5)
        mine = [(r["doc_id"], r[recommend.SCORE]) for r in got if r["query_id"] == query_id]
        assert [i for i, _ in mine] == [i for i, _ in expected]
        assert [s for _, s in mine] == pytest.approx([s for _, s in expected], abs=1e-8)


@pytest.mark.parametrize("bounded", [True, False])
def test_scores_of_placed_postings_are_summed_by_document(spark, docs, monkeypatch, bounded):
    monkeypatch.setattr(topk, "worth_bounding", lambda *_: bounded)
    vocab = session.written(tfidf.vocabulary(docs, "job_id", "job_description"), "vocabulary")
    model = tfidf.placed(docs, "job_id", "job_description", vocab)
    scored, real = [], recommend.top_documents
    monkeypatch.setattr(recommend, "top_documents", lambda scores, *a: scored.append(scores) or real(scores, *a))
    asked = spark.createDataFrame(list(QUERIES.items()), "query_id int, query string")
    out = recommend.recommend(asked, docs, top_n=3, model=model).collect()
    plan = scored[0]._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(doc_id" in plan and not re.search(r"hashpartitioning\(query_id#\d+, doc_id#", plan)
    for query_id, query in QUERIES.items():
        got = sorted((r["rank"], r["doc_id"]) for r in out if r["query_id"] == query_id)
        assert [i for _, i in got] == [i for i, _ in plain_ranking(some_docs(), tfidf.STORED, query, 3)]


def test_postings_of_common_terms_lie_apart(spark):
    docs = spark.createDataFrame(list(enumerate(_common_term_docs())), "job_id long, job_description string")
    spec = tfidf.Spec(ngram_range=(1, 1))
    vocab = session.written(tfidf.vocabulary(docs, "job_id", "job_description", spec), "vocabulary")
    model = tfidf.placed(docs, "job_id", "job_description", vocab, spec)
    facts = {r["term"]: r for r in model.bounds.collect()}
    assert facts["every"]["df"] == 400 and facts["every"]["band"] == 4 and facts["kova"]["band"] < 4
    tops = {r["term"]: r["top"] for r in model.postings.groupBy("term").agg(F.max("weight").alias("top")).collect()}
    assert {t: r["top"] for t, r in facts.items()} == tops
    plan = topk._in_bands(model.postings, model.bounds.filter("band < 4")).filter("weight > 0")._jdf.queryExecution().toString()
    assert "PartitionFilters: [band" in plan.replace("isnotnull(band), ", "").replace("[isnotnull(band#", "[band#")


def test_ranked_documents_with_skills(spark, docs):
    asked = spark.createDataFrame([(1, "python sql")], "query_id int, query string")
    ranked = recommend.recommend(asked, docs, top_n=2)
    full = recommend.with_documents(ranked, docs).orderBy("rank").collect()
    assert full[0][recommend.SKILLS] == ["python", "sql"] and full[0]["job_id"] == 0
    assert recommend.SKILLS not in recommend.with_documents(ranked, docs, skills_field="absent").columns


def test_unknown_field(docs, spark):
    asked = spark.createDataFrame([(1, "x")], "query_id int, query string")
    with pytest.raises(ValueError, match="nope"):
        recommend.recommend(asked, docs, text="nope")


def test_stored_updated_and_cached_models(spark, docs, folder):
    spec = tfidf.Spec(max_features=15)
    built = models.build_and_save(docs, "job_id", "job_description", folder, "v1", spec)
    loaded = models.load(spark, folder, "v1", spec)
    assert sorted(built.postings.collect()) == sorted(loaded.postings.collect())
    assert [r["term_id"] for r in loaded.vocab.orderBy("term").collect()] == list(range(15))

    edited = spark.createDataFrame([(1, "cloud cloud team"), (100, "brand new listing"), (0, "")], "job_id long, job_description string")
    after = docs.join(edited.select("job_id"), "job_id", "left_anti").unionByName(edited)
    updated = models.update_and_save(after, edited, "job_id", "job_description", folder, "v1", "v2", spec)
    fresh = tfidf.fit(after, "job_id", "job_description", spec)
    by_term = lambda m: {(r["doc_id"], r["term"]): r["weight"] for r in m.postings.collect()}
    assert by_term(updated) == pytest.approx(by_term(fresh))

    row = models.registry_row(spark, built, "v1", 62, "batch_1", F.lit("2026-01-08").cast("timestamp")).first()
    assert (row["feature_count"], row["ngram_range"], row["status"], row["trained_on_jobs_count"]) == (15, "(1, 2)", "active", 62)
    assert models.summary(built).first().asDict() == {"vocab_size": 15, "ngram_range": "(1, 2)"}

    now = [0.0]
    cache = models.ModelCache(spark, folder, ttl_seconds=10, clock=lambda: now[0])
    first = cache.get("v1", spec)
    assert cache.get("v1", spec) is first and first.vocab.is_cached
    now[0] = 11.0
    assert cache.get("v1", spec) is not first
    cache.invalidate()
    assert cache.versions() == []


@pytest.mark.parametrize("size", [0, 1, 7, 40, 399, 400, 1000])
def test_cut_by_histograms(spark, size):
    """Against a plain sort, with many ties, the cut inside a level and inside equal first letters, and more terms asked than there are."""
    rng = random.Random(size)
    rows = [(f"{a}{b}{i}", rng.choice([1, 1, 1, 2, 5, 1000, 1001, 1002, 10**12]), 1 + i) for i in range(4) for a in "abcdefghij" for b in "abcdefghij"]
    totals = spark.createDataFrame(rows, "term string, cf bigint, df bigint")
    kept = [r["term"] for r in tfidf.most_frequent(totals, size).collect()]
    assert kept == [t for t, *_ in sorted(rows, key=lambda r: (-r[1], r[0]))[:size]]


def test_cut_puts_only_its_own_level_in_order(spark):
    """Of many terms seen once, those before the cut by cf and first letters are all that is sorted."""
    totals = spark.range(20_000).select(F.concat(F.char(97 + F.col("id") % 26), F.char(97 + F.floor(F.col("id") / 26) % 26), "id").alias("term"))
    totals = totals.withColumns({"cf": F.when(F.hash("term") % 500 == 0, 9).otherwise(1).cast("bigint"), "df": F.lit(1).cast("bigint")})
    assert 100 <= tfidf.down_to_cut(totals, 100).count() < 200
    assert tfidf.most_frequent(totals, 100).count() == 100


def test_term_ids_over_many_ranges(spark):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        vocab = spark.range(5000).select(F.concat(F.lit("t"), F.sha1(F.col("id").cast("string"))).alias("term"))
        numbered = tfidf.with_term_ids(vocab).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    in_order = sorted(numbered, key=lambda r: r["term_id"])
    assert [r["term_id"] for r in in_order] == list(range(5000))
    assert [r["term"] for r in in_order] == sorted(r["term"] for r in numbered)
    assert tfidf.with_term_ids(vocab.limit(0)).collect() == []


def test_lemmas_in_a_model(spark):
    docs = spark.createDataFrame([(1, "jobs and job"), (2, "boxes")], "id int, text string")
    lemmas = spark.createDataFrame([("jobs", "job"), ("boxes", "b")], "form string, lemma string")
    counts = {(r["doc_id"], r["term"]): r["tf"] for r in tfidf.term_counts(docs, "id", "text", lemmas=lemmas).collect()}
    assert counts == {(1, "job"): 2, (1, "and"): 1, (1, "job and"): 1, (1, "and job"): 1}


# --- scores of rankings ----------------------------------------------------------------------------------


def frames(spark, recs, truth, queries):
    recs = [(q, i, item) for q, items in recs.items() for i, item in enumerate(items, 1)]
    return (
        spark.createDataFrame(recs, "query string, rank int, item string"),
        spark.createDataFrame([(q, i) for q, items in truth.items() for i in items], "query string, item string"),
        spark.createDataFrame([(q,) for q in queries], "query string"),
    )


def test_known_metrics(spark):
    asked = ["data scientist", "data engineer"]
    recs, truth, queries = frames(spark, {q: ["id1", "id2", "id3"] for q in asked}, {asked[0]: ["id2"], asked[1]: ["id3", "id4"]}, asked)
    out = evaluate.evaluate(recs, truth, queries).first().asDict()
    assert out == pytest.approx(
        {"p_at_1": 0, "p_at_5": 1 / 3, "p_at_10": 1 / 3, "r_at_1": 0, "r_at_5": 0.75, "r_at_10": 0.75, "mrr": 5 / 12}
    )


def test_edges_of_metrics(spark):
    recs, truth, queries = frames(spark, {"q": ["a", "a", "b"]}, {"q": ["a"], "other": ["z"]}, ["q", "unasked"])
    rows = {r["query"]: r.asDict() for r in evaluate.per_query_metrics(recs, truth, queries, (0, 2)).collect()}
    assert rows["q"]["r_at_2"] == 2.0 and rows["q"]["p_at_0"] == 0.0 and rows["q"]["mrr"] == 1.0
    assert set(rows["unasked"].values()) == {"unasked", 0.0}
    none = evaluate.evaluate(recs, truth, queries.limit(0)).first().asDict()
    assert set(none.values()) == {0.0}


def test_pluggable_recommender(spark):
    recs, truth, queries = frames(spark, {"q": ["a", "b"]}, {"q": ["b"]}, ["q"])
    asked = []

    def recommender(df, k):
        asked.append(k)
        return recs

    assert evaluate.evaluate_recommender(recommender, queries, truth, (1, 2)).first()["mrr"] == 0.5 and asked == [2]


# --- search -----------------------------------------------------------------------------------------------


def grams(text):
    words = "".join(ch.lower() if ch.isalnum() else " " for ch in text or "").split()
    return {f"  {w} "[i : i + 3] for w in words for i in range(len(w) + 1)}


@pytest.mark.parametrize("small", [True, False])
def test_fuzzy_search_like_comparing_every_pair(spark, folder, monkeypatch, small):
    if not small:  # the path of query sides too large to broadcast, with frequent trigrams dealt out
        monkeypatch.setattr(search, "is_small", lambda *_: False)
        monkeypatch.setattr(search, "SALT_ROWS", 10)
    rng = random.Random(8)
    texts = ["machine learning" if i % 3 == 0 else "".join(rng.choice("abc learnig,") for _ in range(rng.randint(0, 25))) for i in range(120)]
    texts += [None, ""]
    asked = {1: "machine learning", 2: "lear, ab", 3: "zzz", 4: ""}
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    queries = spark.createDataFrame(list(asked.items()), "query_id int, query string")
    search.write_index(docs, "id", "text", f"{folder}/index", 16)
    for threshold in (0.3, 0.8) if small else (0.3,):
        many = search.fuzzy_search_many(docs, "id", "text", queries, threshold, 15).collect()
        indexed = search.fuzzy_search_indexed(spark, f"{folder}/index", "id", queries, threshold, 15).collect()
        assert sorted(indexed) == sorted(many)
        for query_id, query in asked.items():
            scored = [(len(grams(query) & grams(t)) / max(1, len(grams(query) | grams(t))), i) for i, t in enumerate(texts)]
            best = sorted(((-s, i) for s, i in scored if s >= threshold))[:15]
            got = sorted((-r["similarity"], r["id"]) for r in many if r["query_id"] == query_id)
            assert [i for _, i in got] == [i for _, i in best]
            if small and threshold == 0.3:
                one = search.fuzzy_search(docs, "id", "text", query, threshold, 15).collect()
                assert [r["id"] for r in one] == [i for _, i in best]


def test_search_joins_rare_trigrams_and_reads_their_buckets_only(spark, folder, monkeypatch):
    docs = spark.createDataFrame([(i, f"the same old words {i % 50:03d}x{i}") for i in range(300)], "id long, text string")
    queries = spark.createDataFrame([(1, "the same old words 007x7")], "query_id int, query string")
    met, real = [], search.meet
    monkeypatch.setattr(search, "meet", lambda *a: met.append(real(*a)) or met[-1])
    assert search.fuzzy_search_many(docs, "id", "text", queries, 0.9).count() == 1
    every = sum(len(grams("the same old words 007x7") & grams(f"the same old words {i % 50:03d}x{i}")) for i in range(300))
    assert sum(m.count() for m in met) < every / 10
    plans = [m._jdf.queryExecution().executedPlan().toString() for m in met]
    assert not any("text" in line for plan in plans for line in plan.splitlines() if "Exchange" in line)

    met.clear()
    search.write_index(docs, "id", "text", f"{folder}/index", 512)
    assert search.fuzzy_search_indexed(spark, f"{folder}/index", "id", queries, 0.9).count() == 1
    wanted = queries.select(F.explode(search.trigrams(F.col("query"))).alias("g"))
    wanted = {r["b"] for r in wanted.select(search.bucket_of(F.col("g"), 512).alias("b")).collect()}
    for m, some in zip(met, (True, False)):
        run = m._jdf.queryExecution()
        assert "PartitionFilters: [" in run.executedPlan().toString().replace("PartitionFilters: []", "")
        buckets = {int(b) for b in re.search(r"bucket#\d+ IN \(([\d,]+)\)", run.analyzed().toString())[1].split(",")}
        assert buckets <= wanted and (not some or len(buckets) < len(wanted) / 2)


def test_search_by_common_trigrams_shuffles_no_pairs_of_query_and_text(spark, folder):
    rng = random.Random(4)
    texts = ["".join(rng.choice("abcd efé½") for _ in range(rng.randint(0, 40))) for _ in range(150)]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(3)
    asked = {i: texts[i][:25] for i in range(20)}
    queries = spark.createDataFrame(list(asked.items()), "query_id int, query string")
    search.write_index(docs, "id", "text", f"{folder}/index", 8)
    found = [search.fuzzy_search_many(docs, "id", "text", queries), search.fuzzy_search_indexed(spark, f"{folder}/index", "id", queries)]
    for rows in found:
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"hashpartitioning\(query_id#\d+L?, id#", plan)
        for query_id, query in asked.items():
            scored = [(len(grams(query) & grams(t)) / max(1, len(grams(query) | grams(t))), i) for i, t in enumerate(texts)]
            best = sorted((-s, i) for s, i in scored if s >= 0.3)[:20]
            assert sorted((-r["similarity"], r["id"]) for r in rows.filter(F.col("query_id") == query_id).collect()) == best


def test_search_counts_the_trigrams_of_all_texts_once(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"some words {i}") for i in range(30)], "id long, text string")
    queries = spark.createDataFrame([(1, "some words 7"), (2, "words")], "query_id int, query string")
    given, real = [], search.query_grams
    monkeypatch.setattr(search, "query_grams", lambda q, frequencies, t: given.append(frequencies) or real(q, frequencies, t))
    assert search.fuzzy_search_many(docs, "id", "text", queries).count() > 0
    assert "Aggregate" not in given[0]._jdf.queryExecution().executedPlan().toString()  # read from files, not counted at each use


def test_contains_takes_wildcards_as_text(spark):
    df = spark.createDataFrame([("100% remote",), ("1000 remote",)], "t string")
    assert df.filter(search.contains_ignore_case("t", "100% REM")).count() == 1


def test_stored_documents_of_one_row_are_weighed_where_they_lie(spark, folder, monkeypatch):
    rows = [(i, t) for i, t in enumerate(some_docs())]
    docs = spark.createDataFrame(rows, "job_id long, job_description string").repartition(3)
    monkeypatch.setattr(tfidf, "weigh", None)  # it deals all counts by document
    spec = tfidf.Spec(max_features=20, sublinear_tf=True)
    model = models.build_and_save(docs, "job_id", "job_description", folder, "v1", spec)
    monkeypatch.undo()
    found = {(r.doc_id, r.term): r.weight for r in model.postings.collect()}
    counts = tfidf.term_counts(docs, "job_id", "job_description", spec)
    expected = {(r.doc_id, r.term): r.weight for r in tfidf.weigh(counts, model.vocab.drop("term_id"), spec).collect()}
    assert found == pytest.approx(expected, rel=1e-12) and len(found) > 100


def test_stored_documents_of_several_rows_have_one_length(spark, folder):
    texts = ["data python data", "sql cloud", "python team", None, "cloud cloud etl", "data etl", ""]
    docs = spark.createDataFrame(list(zip(["a", "b", "a", "a", None, None, "c"], texts)), "job_id string, job_description string")
    spec = tfidf.Spec(max_features=9, ngram_range=(1, 2))
    model = models.build_and_save(docs, "job_id", "job_description", folder, "v1", spec)
    found = sorted((r.doc_id or "", r.term, round(r.weight, 12)) for r in model.postings.collect())
    counts = tfidf.term_counts(docs, "job_id", "job_description", spec)
    plain = tfidf.weigh(counts, model.vocab.drop("term_id"), spec).collect()
    assert found == sorted((r.doc_id or "", r.term, round(r.weight, 12)) for r in plain) and len(found) > 8
    lengths = defaultdict(float)
    for key, _, weight in found:
        lengths[key] += weight * weight
    assert lengths == pytest.approx({"": 1.0, "a": 1.0, "b": 1.0})
