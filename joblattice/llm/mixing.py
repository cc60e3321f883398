"""Mixing to target weights by soft domain membership, in DataFrame expressions alone.

The labelled table defines domains (toxic, high and low quality). A Gaussian classifier over surface
features and hits of learned words, fitted from sums that Spark adds up, gives every document its
posterior of each domain. Projected gradient steps then fit nonnegative document rates whose expected
token totals by domain match the targets: with A the tokens times posteriors, t the targets and
M = (A A')^-1 over the documents whose rate is not cut off, the loss (Ar - t)' M (Ar - t) has unit curvature
there, so each step is r = max(0, r - A' M (Ar - t)). A step needs only the totals Ar and A A', a few numbers
for all domains; a rate is the fold of all steps over its own row.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from joblattice.llm.shared import WORD, free_name, hash_sample, staged

#: Share of the tokens that each domain is to hold; domains without labels drop out, the rest is scaled up.
TARGETS = {"high": 0.85, "low": 0.10, "toxic": 0.05}
FEATURES = ("size", "word", "symbols", "digits", "lines", "wide", "hits")


@dataclass(frozen=True)
class Spec:
    """``max_word_docs`` bounds the labelled sample from which the words of ``word_domain`` are learned."""

    max_word_docs: int = 5_000
    max_words: int = 32
    word_domain: str = "toxic"
    max_steps: int = 40
    tolerance: float = 1e-4
    seed: int = 7


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once a row, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def domain(quality: Column, toxic: Column) -> Column:
    """Null unless both labels are known, or the row is toxic."""
    return F.when(toxic > 0, "toxic").when(toxic.isNull(), None).when(quality > 0, "high").when(quality == 0, "low")


def _labelled(labels: DataFrame) -> DataFrame:
    """(id, domain): one row per labelled id; toxic rows win, then low quality."""
    rows = labels.select(F.col("doc_id").alias("id"), F.col("quality").alias("q"), F.col("toxic").alias("t"))
    rows = rows.where("id is not null").groupBy("id").agg(F.min("q").alias("q"), F.max("t").alias("t"))
    return rows.select("id", domain(F.col("q"), F.col("t")).alias("domain")).where("domain is not null")


def learn_words(docs: DataFrame, labels: DataFrame, spec: Spec) -> list[str]:
    """The words that set ``word_domain`` apart, strongest first."""
    sample = hash_sample(_labelled(labels), F.col("id"), spec.max_word_docs)
    texts = docs.select(F.col("doc_id").alias("id"), F.col("text").alias("text")).join(F.broadcast(sample), "id")
    texts = texts.groupBy(F.col("text")).agg(F.max(F.col("domain") == spec.word_domain).alias("in"))
    texts = staged(texts, "mix-words")
    n1, n = (int(v or 0) for v in texts.agg(F.sum(F.col("in").cast("int")), F.count("*")).first())
    if not n1 or n1 == n:
        return []
    words = texts.select("in", F.explode(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"))).alias("w"))
    counts = words.where("length(w) between 3 and 40").groupBy("w").agg(
        F.sum(F.col("in").cast("int")).alias("a"), F.sum((~F.col("in")).cast("int")).alias("b")
    )
    odds = F.log((F.col("a") + 0.5) / (n1 + 1.0)) - F.log((F.col("b") + 0.5) / (n - n1 + 1.0))
    sure = odds / F.sqrt(1 / (F.col("a") + 0.5) + 1 / (F.col("b") + 0.5))
    best = counts.where((odds > 3) & (F.col("a") >= max(2, n1 // 50))).orderBy(sure.desc(), "w")
    return [r[0] for r in best.select("w").limit(spec.max_words).collect()]


def features(words: list[str], text: Column) -> dict[str, Column]:
    """Token count and features; a null text counts as empty."""
    text = F.coalesce(text, F.lit(""))
    n = F.length(text)
    per = lambda count: F.round(1000.0 * count / (n + 20.0), 6)
    hits = F.lit(0.0)
    if words:
        hits = F.regexp_count(F.lower(text), F.lit(r"(?<![\p{L}\p{N}])(?:" + "|".join(words) + r")(?![\p{L}\p{N}])"))
    tokens = F.regexp_count(text, F.lit(WORD))
    return {
        "tokens": tokens.cast("bigint"),
        "size": F.round(F.log1p(n), 6),
        "word": F.round(n / (tokens + 1.0), 6),
        "symbols": per(F.regexp_count(text, F.lit(r"[^\p{L}\p{N}\s]"))),
        "digits": per(F.regexp_count(text, F.lit("[0-9]"))),
        "lines": per(n - F.length(F.replace(text, F.lit("\n"), F.lit("")))),
        "wide": per(F.octet_length(text) - n),
        "hits": F.round(F.log1p(hits), 6),
    }


@dataclass
class Classifier:
    words: list[str]
    domains: list[str]
    log_prior: list[float]
    mean: list[list[float]]
    var: list[list[float]]

    def posteriors(self, value: Column) -> Column:
        """An array with one number per domain from a struct of features; they add up to 1."""
        if len(self.domains) == 1:
            return F.array(F.lit(1.0))
        scores = []
        for k in range(len(self.domains)):
            score = F.lit(self.log_prior[k])
            for f, m, v in zip(FEATURES, self.mean[k], self.var[k]):
                score = score - F.pow(value[f] - m, F.lit(2.0)) / (2 * v) - float(np.log(v)) / 2
            scores.append(score)

        def shares(e: Column) -> Column:
            return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, b: a + b))

        return let(F.array(*scores), lambda s: let(F.transform(s, lambda x: F.exp(x - F.array_max(s))), shares))


def fit_classifier(measured: DataFrame, labels: DataFrame, words: list[str]) -> Classifier:
    """From measured features (id and features); without labels there is one domain, ``all``."""
    met = measured.join(_labelled(labels), "id")
    sums = [F.avg(f).alias(f"m_{f}") for f in FEATURES] + [F.var_pop(f).alias(f"v_{f}") for f in FEATURES]
    rows = met.groupBy("domain").agg(F.count("*").alias("n"), *sums).orderBy("domain").collect()
    if not rows:
        return Classifier(words, ["all"], [0.0], [], [])
    n = sum(r["n"] for r in rows)
    pooled = {f: sum(r["n"] * (r[f"v_{f}"] + r[f"m_{f}"] ** 2) for r in rows) / n for f in FEATURES}
    centre = {f: sum(r["n"] * r[f"m_{f}"] for r in rows) / n for f in FEATURES}
    floor = {f: 0.01 * max(pooled[f] - centre[f] ** 2, 0.0) + 1e-6 for f in FEATURES}
    return Classifier(
        words,
        [r["domain"] for r in rows],
        [float(np.log(r["n"] / n)) for r in rows],
        [[round(r[f"m_{f}"], 9) for f in FEATURES] for r in rows],
        [[round(max(r[f"v_{f}"], floor[f]), 9) for f in FEATURES] for r in rows],
    )


def _rate(steps: list[list[float]], tokens: Column, share: Column) -> Column:
    """The fold of all gradient steps, from rate 1, each cut at 0."""
    if not steps:
        return F.lit(1.0)
    listed = F.array(*[F.array(*[F.lit(float(g)) for g in step]) for step in steps])

    def one(rate: Column, step: Column) -> Column:
        move = F.aggregate(F.zip_with(step, share, lambda g, p: g * p), F.lit(0.0), lambda a, b: a + b)
        return F.greatest(F.lit(0.0), rate - tokens * move)

    return F.aggregate(listed, F.lit(1.0), one)


@dataclass
class Plan:
    """What decides a document's rate: the classifier and the gradient steps; ``totals`` as fitted."""

    classifier: Classifier
    steps: list[list[float]]
    wanted: dict[str, float]
    totals: dict[str, float]
    seed: int

    def rate(self, tokens: Column, share: Column) -> Column:
        return F.round(_rate(self.steps, tokens.cast("double"), share), 6)

    def copies(self, rate: Column, doc_id: Column, tokens: Column) -> Column:
        """The whole part of the rate, and one more if a hash of the id falls below the rest."""
        u = F.pmod(F.xxhash64(doc_id, tokens, F.lit(self.seed)), F.lit(1 << 30)) / float(1 << 30)
        return (F.floor(rate) + F.when(u < rate - F.floor(rate), 1).otherwise(0)).cast("bigint")


def fit(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None, spec: Spec, keep: list[str]) -> tuple:
    """(plan, measured, shares, name): columns ``keep`` of ``docs`` with a written struct ``name`` of tokens and features, and the
    written (id, tokens, share) of every row.

    The token budget is that of the input. Documents without tokens weigh nothing and keep rate 1.
    """
    words, name = learn_words(docs, labels, spec), free_name(docs.columns, "_mix")
    values = features(words, F.col("text"))
    measured = docs.withColumn(name, F.struct(*[c.alias(n) for n, c in values.items()])).select(*keep, name)
    measured = staged(measured, "mix-features")
    slim = measured.select(F.col("doc_id").alias("id"), F.col(name).alias("value"))
    classifier = fit_classifier(slim.select("id", "value.*"), labels, words)
    rows = slim.select("id", F.col("value.tokens").alias("tokens"), classifier.posteriors(F.col("value")).alias("share"))
    rows = staged(rows, "mix-shares")
    k = range(len(classifier.domains))
    tokens, share = F.col("tokens").cast("double"), F.col("share")
    pairs = [(i, j) for i in k for j in k if i <= j]
    sums = rows.agg(F.sum(tokens)).first()
    budget = float(sums[0] or 0.0)
    targets = TARGETS if targets is None else targets
    weight = np.array([targets.get(d, 0.0) for d in classifier.domains])
    weight = weight / weight.sum() if weight.sum() > 0 else np.full(len(weight), 1.0 / len(weight))
    wanted = weight * budget
    steps: list[list[float]] = []
    totals = np.zeros(len(k))
    while budget:
        kept = rows.select(tokens.alias("m"), "share", _rate(steps, tokens, share).alias("rate"))
        weighed = F.col("m") * F.col("m") * (F.col("rate") > 0).cast("double")
        found = kept.agg(
            *[F.sum(F.col("rate") * F.col("m") * share[i]) for i in k],
            *[F.sum(weighed * share[i] * share[j]) for i, j in pairs],
        ).first()
        totals = np.array([float(v or 0.0) for v in found[: len(k)]])
        if np.abs(totals - wanted).max() <= spec.tolerance * budget or len(steps) == spec.max_steps:
            break
        gram = np.zeros((len(k), len(k)))
        for (i, j), v in zip(pairs, found[len(k) :]):
            gram[i, j] = gram[j, i] = float(v or 0.0)
        steps.append([float(f"{v:.12g}") for v in np.linalg.pinv(gram, rcond=1e-9) @ (totals - wanted)])
    named = lambda v: dict(zip(classifier.domains, map(float, v)))
    return Plan(classifier, steps, named(wanted), named(totals), spec.seed), measured, rows, name


def rates(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, spec: Spec = Spec()) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, the posteriors, rate and copies.

    Null and empty texts have no tokens and keep rate 1. Labels with null ids or without a known kind
    are left out, repeated labels of an id count once. Without labels all documents are one domain.
    Repeated rows get equal rates. An empty table gives an empty result.
    """
    plan, _, shares, _ = fit(docs.select("doc_id", "text"), labels, targets, spec, ["doc_id"])
    rate = plan.rate(F.col("tokens"), F.col("share"))
    named = [F.round(F.col("share")[i], 6).alias(f"p_{d}") for i, d in enumerate(plan.classifier.domains)]
    decided = shares.select(F.col("id").alias("doc_id"), F.col("tokens").alias("n_tokens"), *named, let(rate, lambda r: r).alias("rate"))
    return decided.withColumn("copies", plan.copies(F.col("rate"), F.col("doc_id"), F.col("n_tokens")))


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, spec: Spec = Spec()) -> DataFrame:
    """The rows of ``docs``, each as often as its rate says: the whole part, and one more by a hash of its id."""
    plan, measured, _, name = fit(docs, labels, targets, spec, docs.columns)
    tokens = F.col(f"{name}.tokens")
    copies = let(
        let(plan.classifier.posteriors(F.col(name)), lambda share: plan.rate(tokens, share)),
        lambda rate: plan.copies(rate, F.col("doc_id"), tokens),
    )
    repeated = F.explode(let(copies, lambda n: F.when(n > 0, F.sequence(F.lit(1).cast("bigint"), n))))
    return measured.withColumn(name, repeated).drop(name)
