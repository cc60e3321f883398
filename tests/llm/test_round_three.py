"""Column-block clustering, hard negatives and site templates beside plain versions, and on odd tables."""

from __future__ import annotations

import hashlib
import math
import pickle
import random
import sys
import tracemalloc

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from joblattice.llm import hard_negatives, html, lloyd, lm, tokens

VECTORS = "vec_id long, embedding array<float>, label int, cluster int, distance string, a int, score double"


def _vectors(seed: int, n: int, width: int, spread: int = 5, first: int = 0):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(spread, width))
    x = (centres[r.integers(0, spread, n)] + 0.4 * r.normal(size=(n, width))).astype(np.float32)
    return [(first + i, x[i].tolist(), int(r.integers(0, 4))) for i in range(n)]


def _frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "c", 2, 0.5) for r in rows], VECTORS).repartition(3)


def _plain_lloyd(rows, k, rounds, width, scale):
    kept = [
        (i, [math.floor(scale * float(np.float32(c))) for c in v])
        for i, v, _ in rows
        if v is not None and len(v) == width and all(c is not None and math.isfinite(c) for c in v)
    ]
    order = sorted((hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)
    centroids = [list(v) for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for j in range(len(centroids)):
            mine = [v for (_, v), o in zip(kept, own) if o == j]
            if mine:
                centroids[j] = [sum(c) // len(mine) for c in zip(*mine)]
    last = [(i, *nearest(v)[::-1]) for i, v in kept]
    per = {j: sum(d for _, c, d in last if c == j) for j in range(len(centroids))}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    total = sum(per.values())
    return sorted(((i, c, d, per[c], total, digest[c]) for i, c, d in last), key=repr)


def _sorted(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


ODD = [
    (900, None, 1),
    (901, [], 1),
    (902, [1.0] * 5, 1),
    (903, [1.0] * 11 + [None], 2),
    (904, [1.0] * 11 + [float("nan")], 2),
    (905, [float("inf")] * 12, 2),
    (906, [0.0] * 12, 3),
    (None, [0.5] * 12, 0),
    (907, [0.25] * 12, None),
]


def test_lloyd_by_plain_rounds(spark):
    rows = _vectors(4, 150, 12) + ODD
    rows += rows[3:6] + [(7, rows[9][1], 2)]  # repeated rows, and an id with two vectors
    found = lloyd.cluster(_frame(spark, rows), k=5, rounds=4, width=12, scale=1024, block=5)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert _sorted(found) == _plain_lloyd(rows, 5, 4, 12, 1024)


def test_lloyd_large_components_few_rows_and_ties(spark):
    r = random.Random(2)
    large = [(i, [r.choice([-9e4, 5e3, 1e5]) * r.random() for _ in range(6)], 0) for i in range(40)]
    assert _sorted(lloyd.cluster(_frame(spark, large), k=3, rounds=3, width=6, block=4)) == _plain_lloyd(large, 3, 3, 6, 1024)
    few = [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)]
    assert _sorted(lloyd.cluster(_frame(spark, few), k=8, rounds=2, width=2)) == _plain_lloyd(few, 8, 2, 2, 1024)
    beyond = [*few, (3, [1e30, 0.0], 0)]
    assert _sorted(lloyd.cluster(_frame(spark, beyond), k=8, rounds=2, width=2)) == _plain_lloyd(few, 8, 2, 2, 1024)
    none = lloyd.cluster(_frame(spark, few).limit(0), k=8, rounds=2, width=2)
    assert none.count() == 0 and none.columns[0] == "vec_id"


def test_lloyd_keeps_sums_that_do_not_fit_as_null(spark):
    rows = [(i, [4e7 * i, 0.0], 0) for i in range(4)]
    got = lloyd.cluster(_frame(spark, rows), k=1, rounds=0, width=2).collect()
    assert all(r.inertia is None for r in got) and min(r.distance for r in got if r.distance is not None) == 0


def _plain_negatives(rows, every, n_pos=5, n_neg=3, low=50, high=95, scale=256):
    kept = [
        (i, [math.floor(scale * float(np.float32(c))) for c in v], label)
        for i, v, label in rows
        if i is not None and label is not None and v and all(c is not None and math.isfinite(c) for c in v)
    ]
    out = []
    for i, v, label in kept:
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, m) for j, w, m in kept if j != i and len(w) == len(v))
        for s, j, m in [x for x in scored if x[2] == label][:n_pos]:
            inside = [x for x in scored if x[2] != label and low * -s <= 100 * -x[0] <= high * -s][:n_neg]
            out += [(i, j, rank, x[1], -s, -x[0]) for rank, x in enumerate(inside, 1)]
    return sorted(out, key=repr)


def test_negatives_by_plain_search_over_many_blocks(spark, monkeypatch):
    rows = _vectors(8, 700, 12, spread=3) + ODD + [(2, [1.0, 2.0, 3.0], 1), (4, [1.0, 2.0, 2.0], 1), (5, [1.0, 1.5, 2.0], 0)]
    rows += rows[20:24] + rows[40:41] * 2
    rows = [(i, v, 0 if label is not None and j % 3 == 0 else label) for j, (i, v, label) in enumerate(rows)]  # one hot label
    want = _plain_negatives(rows, 20)
    assert len(want) > 100
    for block, share, anchors in ((64, 32, 7), (4096, 2048, 128)):
        monkeypatch.setattr(hard_negatives, "BLOCK", block)
        monkeypatch.setattr(hard_negatives, "SHARE", share)
        monkeypatch.setattr(hard_negatives, "ANCHORS", anchors)
        found = hard_negatives.mine(_frame(spark, rows), F.col("vec_id") % 20 == 0)
        assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
        assert _sorted(found) == want


def test_negatives_of_large_numbers_and_of_none(spark):
    r = random.Random(1)
    rows = [(i, [r.choice([1.0, 3e6, 9e9]) * r.random() for _ in range(4)], i % 2) for i in range(60)]
    want = [(a, p, n, o, *(s if s < 1 << 63 else None for s in scores)) for a, p, n, o, *scores in _plain_negatives(rows, 10)]
    assert _sorted(hard_negatives.mine(_frame(spark, rows), F.col("vec_id") % 10 == 0)) == sorted(want, key=repr)
    assert hard_negatives.mine(_frame(spark, rows).limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert hard_negatives.mine(_frame(spark, rows), F.lit(None).cast("boolean")).count() == 0


def test_threshold_stops_before_all_rows_are_read():
    r = np.random.default_rng(5)
    x = np.rint(r.normal(size=(2000, 3)) * 100).astype(np.int64)
    x[::50] *= 6
    lists = hard_negatives.Lists(list(range(2000)), [0] * 2000, x, 1000)
    anchor = np.array([200, -150, 0])
    got = lists.search(anchor, lists.eligible(-1, 0, True), [(None, None)], 4)[0]
    want = sorted((-int(s), i) for i, s in enumerate(x @ anchor))[:4]
    assert got == [(-s, i) for s, i in want]
    assert lists.reads < 1000


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain &lt;b&gt; text", "plain <b> text"),
        ("a < b and </3> c", "a < b and c"),
        ("<p>one<p>two<br>three  <b>fo</b>ur\n\t&nbsp;five", "one\ntwo three four five"),
        ("<p><b>bold<br><p>next</p></b>", "bold\nnext"),
        ("<p title='a > b'>x</p><p title=\"open>y</p>", "x\ny"),
        ("<script>var t='</p><article>no</article>'</script><p>x<style>p{}</style>y</p>", "xy"),
        ("<nav>menu</nav><p>x</p><aside>side</aside><form><input>send</form><footer>foot</footer>", "x"),
        ("<body><div class='ad'>buy</div><article><h1>T</h1><p>x</p></article><p>outside</p></body>", "T\nx"),
        ("<article>a</article><article>b</article><article class=comment>c</article>", "a\nb"),
        ("<article><header><nav>m</nav><h2>T</h2><span>by</span></header>x<section id='comments'>c</section></article>", "T\nx"),
        ("<article><p class=lead>x</p><div class='share-bar'>s</div><p hidden>h</p><footer>f</footer>tail</article>", "x\ntail"),
        ("<main><p>x</p></main><p>y</p>", "x"),
        ("<div id=page class=with-sidebar><div class=sidebar>s</div><article>x</article></div>", "x"),
        ("<form id=all><article>x</article></form>", "x"),
        ("<div class=ad>never closed<article><p>x</p></article>", "x"),
        ("<ul><li>a<li>b<ul><li>c</ul></ul><table><tr><td>d<td>e<tr><th>f</table>", "a\nb\nc\nd\ne\nf"),
        ("<!-- c <p>no</p> --><!DOCTYPE html><?x?><p>x<!-- open", "x"),
        ("<P CLASS=Notice>n</P><Article>&copy; &#233;&#x41; &unknown;</ARTICLE>", "© éA &unknown;"),
        ("<article><dl><dt>t<dd>d</dl><blockquote>q</blockquote><pre>a\n b</pre>x<hr>y</article>", "t\nd\nq\na b\nx\ny"),
        ("<div>" * 5000 + "deep", "deep"),
        ("<p>" + "long " * 60000, ("long " * 60000).strip()),
    ],
)
def test_main_text_of_one_page(page, text):
    assert html.main_text(page) == (text, 0)


def _site(host: str, i: int, extra: str = "", licence: str = "") -> str:
    return (
        f"<html><body><div><span>Home of {host}</span></div>{extra}<article><h1>Title {i}</h1><p>Text {i} of {host}.</p>{licence}"
        f"<p class=end><a href=/top>Back to top</a></p></article><div><i>All rights of {host}</i></div></body></html>"
    )


PAGES = "page_id long, url string, html string, host string, text string, n int"


def _pages():
    rows = []
    for i in range(30):
        licence = "<p>Free for all uses.</p>" if i % 2 else ""
        rows.append((i, f"https://User@Big.example:80/{i}", _site("big", i, licence=licence)))
    rows += [(100 + i, f"http://loose.example/{i}", f"<div>Menu of all</div><div>Story {i}</div><div>Rare {i % 12}</div>") for i in range(24)]
    rows += [(200 + i, f"http://tiny.example/{i}", f"<div>Menu of all</div><div>Story {i}</div>") for i in range(2)]
    rows += [(300 + i, "http://copy.example/", "<div>One page crawled often</div>") for i in range(9)]
    rows += [(400 + i, None, f"<div>Menu of all</div><div>Story {i}</div>") for i in range(7)]
    rows += [(500, "not a url", None), (None, "http://big.example/", ""), (30, "http://big.example/x", _site("big", 0))]
    return rows + rows[:2]


def _want(i, url):
    if url is not None and "big" in url.lower() and i is not None:
        i = 0 if i == 30 else i
        return f"Title {i}\nText {i} of big." + ("\nFree for all uses." if i % 2 else ""), 3
    return {
        1: (f"Story {(i or 0) - 100}\nRare {((i or 0) - 100) % 12}", 1),
        2: (f"Menu of all\nStory {(i or 0) - 200}", 0),
        3: ("One page crawled often", 0),
        4: (f"Menu of all\nStory {(i or 0) - 400}", 0),
    }.get((i or 0) // 100, ("", 0))


@pytest.mark.parametrize("small_rows", [1000, 0])
def test_site_templates_are_deleted(spark, monkeypatch, small_rows):
    monkeypatch.setattr(html, "PART", 10)
    rows = _pages()
    df = spark.createDataFrame([(*r, "h", "t", 1) for r in rows], PAGES).repartition(4)
    found = html.extract(df, small_rows=small_rows)
    assert found.columns == ["page_id", "url", "text", "n_chars", "n_deleted"]
    got = sorted(((r.page_id, r.url, r.text, r.n_chars, r.n_deleted > 0) for r in found.collect()), key=repr)
    want = [(i, url, _want(i, url)[0], len(_want(i, url)[0]), _want(i, url)[1] > 0) for i, url, _ in rows]
    assert got == sorted(want, key=repr)
    assert html.extract(df.limit(0)).count() == 0


def test_templates_and_article_share(spark):
    rows = _pages()
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.expr(html.host("url")))
    known = {r.host: (r.n_pages, len(r.template)) for r in html.site_templates(df).collect()}
    assert known["big.example"] == (31, 6)  # first and closing line, link, each with what it stands in
    assert known["loose.example"] == (24, 1)
    assert set(known) == {"big.example", "loose.example"}


def _lm_mixer(seed: int) -> lm.Mixer:
    r, spec = np.random.default_rng(seed), lm.Spec(table_bits=12)
    code = lm.Code([b"w%d" % i for i in range(500)], r.integers(2, 50, 500).tolist(), 40, 9)
    both = [lm._stretched(r.integers(0, 9, (2, 1 << 12))) for _ in range(2)]
    weights = np.tile(np.array([0.3, 0.4, 0.4, 0.1]), (lm._GATES, 1))
    return lm.Mixer(code, spec, tuple(s for s, _ in both), tuple(n for _, n in both), weights)


def test_lm_texts_take_turns(monkeypatch):
    """Texts that follow each other in a place, and windows that reach over their ends, change no result."""
    mixer, r = _lm_mixer(4), random.Random(5)
    texts = [b" ".join(b"w%d" % r.randrange(520) for _ in range(r.choice((0, 1, 7, 30, 200)))) for _ in range(150)]
    monkeypatch.setattr(lm, "_NARROW", 2)
    steps, wide = [], lm._steps
    monkeypatch.setattr(lm, "_steps", lambda x, *rest: steps.append(x.shape[1]) or wide(x, *rest))
    single = [mixer.run(lm.tokens_of([t], mixer.code, False), 0.01) for t in texts]
    monkeypatch.setattr(lm, "_LANES", 40)
    for window in (7, 64, 1000):
        monkeypatch.setattr(lm, "_WINDOW", window)
        steps.clear()
        found, weights, n = mixer.run(lm.tokens_of(texts, mixer.code, False), 0.01)
        assert found == pytest.approx(np.concatenate([s[0] for s in single]), rel=1e-9) and n == 150
        assert weights == pytest.approx(sum(s[1] for s in single), rel=1e-9)
        assert steps[0] == max(steps) == 40


def test_lm_broadcasts_leave_out_what_tasks_can_make():
    mixer = _lm_mixer(6)
    again = pickle.loads(pickle.dumps(mixer))
    assert (again.code.mark_at == mixer.code.mark_at).all() and (again.code.own_at == mixer.code.own_at).all()
    assert all((a == b).all() for a, b in zip(again.both, mixer.both))
    kept = sum(v.nbytes for v in (*mixer.stretch, *mixer.seen, mixer.code.node, mixer.code.bit))
    assert len(pickle.dumps(mixer)) < kept + 40_000


def test_lm_count_tables_are_few_and_small(spark):
    """Neither the number of tables that tasks send nor their bytes follow the number of partitions."""
    docs = spark.range(50).repartition(300)
    assert lm.few_tables(docs).rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism
    assert lm.few_tables(docs).count() == 50
    table = np.zeros((2, 1 << 16), np.int64)
    table[0, 5], table[1, 70], table[1, 40_000], table[0, 65_535] = 3, 300, 2**31 + 5, 7
    row = lm._packed(table, 2)
    assert row.nbytes < 200
    frame = spark.createDataFrame([tuple(r.values()) for r in row.to_pylist() * 2], lm._CELLS)
    expected = np.minimum(2 * table, 2**31 - 1)
    assert (lm.add_tables(frame, {2: 1 << 16})[2] == expected).all()


def test_words_beside_any_white_space_are_encoded_whole():
    assert tokens._BLANK == {"", *(c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace())}
    e = tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [f"a b{c} d, {c}e. f{c}" for c in sorted(tokens._BLANK)] + ["x b d, e. f", "y b. d e, f\n"]
    for _ in range(2):  # new words, then known ones
        assert e.encode(texts) == [np.array([*e._ids(t), tokens.END_ID], "<u4").tobytes() for t in texts]


def test_lm_mixing_holds_few_bytes_for_each_token():
    r = np.random.default_rng(3)
    mixer = _lm_mixer(3)
    code = lm.Code([b"a", b"b", b"c", b"d"], [40, 30, 20, 10], 10, 9)
    mixer = lm.Mixer(code, mixer.spec, mixer.stretch, mixer.seen, mixer.weights)
    texts = [b" ".join(r.choice([b"a", b"b", b"c", b"d", b"e"], 300).tolist()) for _ in range(1300)]
    block = lm.tokens_of(texts, code, False)
    mixer.run(lm.tokens_of(texts[:1], code, False), 0.01)
    peaks = []
    for part in (block, lm.Block(np.tile(block.sym, 3), np.concatenate([block.starts + k * len(block.sym) for k in range(3)]), [])):
        tracemalloc.start()
        logs, _, _ = mixer.run(part, 0.01)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert (peaks[1] - peaks[0]) / (2 * len(block.sym)) < 35  # what a token more takes, its result of 8 included


def test_lm_scores_of_texts_put_together_in_pieces(monkeypatch):
    r = np.random.default_rng(5)
    mixer = pickle.loads(pickle.dumps(_lm_mixer(5)))  # as tasks have it
    words = [b"w%d" % i for i in range(9)] + [b"rare"]
    texts = [b" ".join(r.choice(words, n).tolist()) for n in (0, 300, 5, 1, 40, 0, 90)]
    block = lm.tokens_of(texts, mixer.code, True)
    logs, _, _ = mixer.run(block, 0.01)
    whole = lm.text_scores(block, logs, mixer.code.escape)
    monkeypatch.setattr(lm, "_SCORED", 50)
    assert len(list(block.pieces(lm._SCORED))) > 3
    assert (lm.text_scores(block, logs, mixer.code.escape) == whole).all()
    for a, b, own, part in block.pieces(lm._SCORED):
        alone = lm.tokens_of(texts[a:b], mixer.code, True)
        assert (part.sym == alone.sym).all() and (part.starts == alone.starts).all() and part.rare == alone.rare
        assert own.stop - own.start == len(alone.sym)
