"""Stored term models, their registry rows and a registry of models held in memory."""

from __future__ import annotations

import json
import time
from dataclasses import asdict

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from joblattice.operators import tfidf
from joblattice.operators.rows import align_schema
from joblattice.schemas import MODEL_VERSIONS


def part_path(root: str, part: str, version: str) -> str:
    return f"{root.rstrip('/')}/{part}/model_version={version}"


def _write(df: DataFrame, root: str, part: str, version: str) -> DataFrame:
    path = part_path(root, part, version)
    df.write.mode("errorifexists").parquet(path, compression="zstd" if part == "words" else None)
    return df.sparkSession.read.parquet(path)


def build_and_save(
    docs: DataFrame,
    key: str,
    text: str,
    root: str,
    version: str,
    spec: tfidf.Spec = tfidf.STORED,
    lemmas: DataFrame | None = None,
) -> tfidf.Model:
    """Fit and write a model version.

    The word lists are written first, straight from the rows of the texts, and counted by all later
    steps; the only shuffle by document is that of the terms of documents that are several rows. The
    postings lie by frequency band, and the largest weight of each term beside them, for ``recommend``.
    """
    _write_spec(docs.sparkSession, root, version, spec, lemmas is not None)
    lists = _write(tfidf.word_lists(docs, key, text, spec, lemmas), root, "words", version)
    return _save_from_lists(lists, docs, root, version, spec, lemmas is not None)


def update_and_save(
    docs: DataFrame,
    changed: DataFrame,
    key: str,
    text: str,
    root: str,
    old_version: str,
    version: str,
    spec: tfidf.Spec | None = None,
    lemmas: DataFrame | None = None,
) -> tfidf.Model:
    """A new version in which only the texts of ``changed`` are read again; ``docs`` is only counted.

    The earlier version's word lists stay as they are, and so do its settings unless others are given;
    ``changed`` holds new and edited documents.
    """
    spark = docs.sparkSession
    before, with_lemmas = stored_spec(spark, root, old_version)
    if with_lemmas != (lemmas is not None):
        raise ValueError("the earlier version was made " + ("with" if with_lemmas else "without") + " lemmas")
    spec = before if spec is None else spec
    _write_spec(spark, root, version, spec, with_lemmas)
    stored = spark.read.parquet(part_path(root, "words", old_version))
    fresh = tfidf.word_lists(changed, key, text, spec, lemmas)
    lists = _write(tfidf.replace_counts(stored, changed, key, fresh), root, "words", version)
    return _save_from_lists(lists, docs, root, version, spec, with_lemmas)


def _save_from_lists(lists, docs, root, version, spec, with_lemmas) -> tfidf.Model:
    vocab = tfidf.list_vocabulary(lists, tfidf.count_docs(docs), spec, with_lemmas)
    kind = "int" if tfidf.is_cut(spec) else "bigint"
    vocab = tfidf.with_term_ids(vocab).withColumn("term_id", F.col("term_id").cast(kind))
    vocab = _write(vocab, root, "vocab", version)
    paths = part_path(root, "postings", version), part_path(root, "bounds", version)
    return tfidf.place_lists(lists, vocab, spec, with_lemmas, *paths)


def _write_spec(spark: SparkSession, root: str, version: str, spec: tfidf.Spec, with_lemmas: bool) -> None:
    row = spark.range(1).select(F.lit(json.dumps(asdict(spec))).alias("spec"), F.lit(with_lemmas).alias("with_lemmas"))
    _write(row, root, "spec", version)


def stored_spec(spark: SparkSession, root: str, version: str) -> tuple[tfidf.Spec, bool]:
    """(settings of a stored version, whether lemmas were used); queries need the same lemmas."""
    row = spark.read.parquet(part_path(root, "spec", version)).first()
    values = json.loads(row["spec"])
    lists = {k: tuple(v) for k, v in values.items() if isinstance(v, list)}
    return tfidf.Spec(**{**values, **lists}), row["with_lemmas"]


def load(spark: SparkSession, root: str, version: str, spec: tfidf.Spec | None = None) -> tfidf.Model:
    """A stored version with its settings, right for a few queries: only scores of matching documents move.

    For many queries take it from ``ModelCache``, which places the postings by document once.
    """
    parts = (spark.read.parquet(part_path(root, part, version)) for part in ("vocab", "postings", "bounds"))
    vocab, postings, bounds = parts
    return tfidf.Model(vocab, postings, stored_spec(spark, root, version)[0] if spec is None else spec, bounds)


def registry_row(
    spark: SparkSession,
    model: tfidf.Model,
    version: str,
    trained_on: int,
    created_by: str,
    now: Column,
    root: str = "tfidf",
) -> DataFrame:
    """The active ``model_versions`` row of a model, with its real number of terms."""
    row = model.vocab.agg(F.count(F.lit(1)).alias("feature_count")).withColumns(
        {
            "model_version": F.lit(version),
            "model_type": F.lit("tfidf"),
            "vectorizer_path": F.lit(part_path(root, "vocab", version)),
            "matrix_path": F.lit(part_path(root, "postings", version)),
            "trained_on_jobs_count": F.lit(trained_on),
            "ngram_range": F.lit(str(tuple(model.spec.ngram_range))),
            "status": F.lit("active"),
            "created_at": now,
            "created_by": F.lit(created_by),
            "updated_at": now,
        }
    )
    return align_schema(row, MODEL_VERSIONS)


def summary(model: tfidf.Model) -> DataFrame:
    """One row: vocabulary size and n-gram range."""
    return model.vocab.agg(F.count(F.lit(1)).alias("vocab_size")).withColumn(
        "ngram_range", F.lit(str(tuple(model.spec.ngram_range)))
    )


class ModelCache:
    """Models persisted by version, read through on a miss, dropped on expiry or invalidation."""

    def __init__(self, spark: SparkSession, root: str, ttl_seconds: float = 604800.0, clock=time.monotonic):
        self._spark, self._root, self._ttl, self._clock = spark, root, ttl_seconds, clock
        self._held: dict[str, tuple[float, tfidf.Model]] = {}

    def get(self, version: str, spec: tfidf.Spec | None = None) -> tfidf.Model:
        held = self._held.get(version)
        if held and self._clock() - held[0] < self._ttl:
            return held[1]
        self.invalidate(version)
        stored = load(self._spark, self._root, version, spec)
        level = StorageLevel.MEMORY_AND_DISK
        model = tfidf.Model(stored.vocab.persist(level), stored.postings.repartition(tfidf.DOC).persist(level), stored.spec)
        self._held[version] = (self._clock(), model)
        return model

    def invalidate(self, version: str | None = None) -> None:
        for name in [version] if version else list(self._held):
            entry = self._held.pop(name, None)
            if entry:
                entry[1].vocab.unpersist()
                entry[1].postings.unpersist()

    def versions(self) -> list[str]:
        return sorted(self._held)
