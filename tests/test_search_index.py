"""The stored trigram index: rows by text and bucket, and counting of texts that lie in several batches."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from joblattice.operators import gram_sets, search


def test_index_keeps_a_row_a_text_and_bucket_and_counts_texts_cut_by_batches(spark, folder, monkeypatch):
    monkeypatch.setattr(gram_sets, "CELLS", 12)
    monkeypatch.setattr(gram_sets, "MEETINGS", 30)
    monkeypatch.setattr(gram_sets, "FLAGS", 500)
    rng = random.Random(6)
    texts = ["".join(rng.choice("abcd eé½\U0001d49c\u0130") for _ in range(rng.randint(0, 60))) for _ in range(60)] + [None, ""]
    docs = spark.createDataFrame([(None if i == 5 else f"k{i:02d}", t) for i, t in enumerate(texts)], "id string, text string")
    asked = {i: texts[i][:30] for i in range(9)} | {9: "", 10: "zzz"}
    queries = spark.createDataFrame(list(asked.items()), "query_id int, query string")
    search.write_index(docs, "id", "text", f"{folder}/index", 8)
    rows = spark.read.parquet(f"{folder}/index/postings")
    pairs = docs.select("id", F.explode(search.trigrams(F.col("text"))).alias("g")).withColumn("b", search.bucket_of(F.col("g"), 8))
    held = {(r["id"], r["bucket"], g) for r in rows.collect() for g in r["grams"]}
    assert held == {(r["id"], r["b"], r["g"]) for r in pairs.collect()}
    assert rows.count() == pairs.select("id", "b").distinct().count() < pairs.count() / 2

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        found = search.fuzzy_search_indexed(spark, f"{folder}/index", "id", queries, 0.3, 7).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    name = lambda i: None if i == 5 else f"k{i:02d}"
    every = spark.createDataFrame(list(enumerate([*texts, *asked.values()])), "i int, t string")
    sets = {r[0]: set(r[1]) for r in every.select("i", search.trigrams(F.col("t"))).collect()}
    for query_id in asked:
        mine = sets[len(texts) + query_id]
        scored = [(len(mine & sets[i]) / max(1, len(mine | sets[i])), i) for i in range(len(texts))]
        best = sorted((-s, name(i) or "", name(i)) for s, i in scored if s >= 0.3)[:7]
        got = sorted((-r["similarity"], r["id"] or "") for r in found if r["query_id"] == query_id)
        assert got == [(s, n) for s, n, _ in best]
