"""Joins and searches that must not gather a table in one place, and results beside plain versions."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from joblattice.llm import ann, hard_negatives, simhash


def _plan(df):
    df.collect()  # adaptive execution has then settled on its joins
    return df._jdf.queryExecution().executedPlan().toString()


def test_links_broadcast_no_exploded_keys(spark):
    rng = random.Random(5)
    fps = [rng.getrandbits(63) for _ in range(40)]
    fps += [fps[0] ^ 1, fps[0] ^ 3, fps[1] ^ (1 << 40)]
    found = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp bigint"))
    close = {(min(a, b), max(a, b)) for a in fps for b in fps if a != b and (a ^ b).bit_count() <= 2}
    assert {tuple(r) for r in found.collect()} == close and len(close) == 4
    assert "BroadcastExchange" not in _plan(found)


def test_pipeline_drops_near_copies_without_a_broadcast_of_exploded_keys(spark, monkeypatch):
    written, real = {}, simhash.staged
    monkeypatch.setattr(simhash, "staged", lambda df, label: written.update({label: df}) or real(df, label))
    texts = [" ".join(f"word{k * 31 + i}" for i in range(20)) for k in range(6)]
    docs = spark.createDataFrame([(i, texts[i % 6]) for i in range(18)], "doc_id long, text string")
    kept = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 1, 2, 3, 4, 5]
    assert "BroadcastExchange" not in _plan(written["links"])


def _rows(seed, n, dim, first=0):
    r = np.random.default_rng(seed)
    return [(first + i, [float(x) for x in v], i % 4) for i, v in enumerate(r.normal(size=(n, dim)))]


VECTORS = "vec_id long, embedding array<double>, label int"


def test_one_bit_blocks_are_neither_broadcast_nor_gathered(spark, monkeypatch):
    monkeypatch.setattr(ann, "VECTOR_BLOCK", 40)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 8)
    rows = _rows(1, 260, 24) + _rows(2, 90, 12, 300) + [(900, [1.0, 2.0], 0)]
    vectors = spark.createDataFrame(rows, VECTORS).repartition(3)
    found = ann.nearest(vectors, vectors.where("vec_id % 9 = 0"), 3)
    want = set()
    for q, x, _ in rows:
        unit = np.array(x) / np.linalg.norm(x)
        near = sorted((-float(unit @ (np.array(v) / np.linalg.norm(v))), i) for i, v, _ in rows if i != q and len(v) == len(x))
        want |= {(q, n + 1, i) for n, (_, i) in enumerate(near[:3])} if q % 9 == 0 else set()
    assert {(r["query_id"], r["rank"], r["vec_id"]) for r in found.collect()} == want
    plan = _plan(found)
    assert "Broadcast" not in plan and "collect_list" not in plan


def test_threshold_negatives_blocks_are_neither_broadcast_nor_gathered(spark, monkeypatch):
    for name, size in (("BLOCK", 40), ("SHARE", 20), ("ANCHORS", 8)):
        monkeypatch.setattr(hard_negatives, name, size)
    searched, real = [], hard_negatives._best
    monkeypatch.setattr(hard_negatives, "_best", lambda pairs, k: searched.append(pairs) or real(pairs, k))
    rows = _rows(3, 180, 6) + _rows(4, 60, 3, 300) + [(900, [1.0, 2.0], 0)]
    found = hard_negatives.mine(spark.createDataFrame(rows, VECTORS).repartition(3), F.col("vec_id") % 9 == 0)
    whole = {i: (label, np.floor(256 * np.array(v)).astype(int)) for i, v, label in rows}
    want = set()
    for q in [i for i in whole if i % 9 == 0]:
        label, x = whole[q]
        scored = sorted((-int(v @ x), i) for i, (_, v) in whole.items() if i != q and len(v) == len(x))
        for s, p in [(s, i) for s, i in scored if whole[i][0] == label][:5]:
            inside = [(t, i) for t, i in scored if whole[i][0] != label and -50 * s <= -100 * t <= -95 * s]
            want |= {(q, p, n + 1, i, -s, -t) for n, (t, i) in enumerate(inside[:3])}
    assert {tuple(r) for r in found.collect()} == want and len(want) > 50
    for plan in map(_plan, searched):
        assert "collect_list(struct(a" not in plan and "BroadcastHashJoin [block" not in plan and "dim#" in plan
    assert len(searched) == 2
