"""The daily batch: collect, validate, enrich, vectorize, export.

Every stage reads the table the stage before has written and logs its run, so a failed day can be
looked at and taken up again from any stage.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from joblattice.operators import clean, rows, runs, tables, tfidf, validate
from joblattice.schemas import BATCH_RUNS, JOBS, MODEL_VERSIONS
from joblattice.sources import models, pages
from joblattice.sources.files import MONTH, with_sequence
from joblattice.sources.monthly import MonthlyTable


@dataclass
class Day:
    """Where a batch lives and what it is made with."""

    spark: SparkSession
    root: str
    now: datetime
    limit: int = 500
    locations: Sequence[str] = ()
    spec: tfidf.Spec = tfidf.STORED
    batch_id: str = field(default_factory=lambda: str(uuid4()))

    @property
    def now_col(self) -> Column:
        return F.lit(self.now)

    @property
    def model_version(self) -> str:
        return self.now.strftime("tfidf_v%Y%m%d_%H%M%S")

    def stage_path(self, name: str) -> str:
        return f"{self.root}/batches/{self.batch_id}/{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self.stage_path(name), compression="zstd")
        return self.spark.read.parquet(self.stage_path(name))

    @property
    def jobs(self) -> MonthlyTable:
        return MonthlyTable(self.spark, f"{self.root}/jobs", JOBS)

    def runs_log(self) -> DataFrame:
        return self.spark.read.schema(BATCH_RUNS).parquet(f"{self.root}/batch_runs")

    def model_versions(self) -> DataFrame:
        return self.spark.read.schema(MODEL_VERSIONS).parquet(f"{self.root}/model_versions")


def _run(day: Day, stage: str, work: Callable[[], tuple[DataFrame, dict[str, int]]]) -> DataFrame:
    """Run one stage between its log rows."""
    log = f"{day.root}/batch_runs"

    def note(status: str, **kw) -> None:
        row = runs.run_row(day.spark, day.batch_id, stage, status, F.current_timestamp(), **kw)
        row.write.mode("append").parquet(log)

    note("in_progress")
    started = time.monotonic()
    try:
        out, counts = work()
    except Exception as error:
        note("failed", error_message=f"{stage} failed: {error}", seconds=int(time.monotonic() - started))
        raise
    note("success", counts=counts, seconds=int(time.monotonic() - started))
    return out


def collect(day: Day, landed: DataFrame, sample: DataFrame | None = None) -> DataFrame:
    def work():
        raw = pages.collect_jobs(landed, day.limit, locations=day.locations)
        firsts = rows.keep_first(raw, ["job_id"], "_seq") if rows.has_repeats(raw, ["job_id"]) else raw
        kept = day.keep(firsts, "collected")
        if sample is not None and kept.isEmpty():
            kept = day.keep(with_sequence(pages.unify_schema(sample)), "sample")
        return kept, {"jobs_collected": kept.count()}

    return _run(day, "collect", work)


def check(day: Day, raw: DataFrame, fields: validate.Fields = validate.Fields()) -> DataFrame:
    """The rules run once and their outcome is kept: ``checked`` also is the table of rejects."""

    def work():
        checked = day.keep(validate.with_failed_rules(raw, fields), "checked")
        kept = day.keep(validate.keep_by_valid_key(checked, fields.key), "validated")
        passed = F.count_if(F.size(validate.FAILED) == 0)
        valid, total = checked.agg(passed, F.count(F.lit(1))).first()
        return kept, {"jobs_validated": valid, "jobs_failed": total - valid}

    return _run(day, "validate", work)


def enrich(day: Day, valid: DataFrame) -> DataFrame:
    def work():
        # ``collect`` leaves one row a listing; rows of another origin may repeat, and only then are they shuffled again.
        cleaned = clean.clean_jobs if rows.has_repeats(valid, ["job_id"]) else clean.clean_rows
        kept = day.keep(cleaned(valid, F.to_date(day.now_col)), "enriched")
        return kept, {"jobs_enriched": kept.count()}

    return _run(day, "enrich", work)


def vectorize(day: Day, jobs: DataFrame) -> DataFrame:
    def work():
        version, n = day.model_version, jobs.count()
        model = models.build_and_save(jobs, "job_id", "job_description", f"{day.root}/tfidf", version, day.spec)
        row = models.registry_row(day.spark, model, version, n, f"batch_{day.batch_id}", day.now_col, f"{day.root}/tfidf")
        row.write.mode("append").parquet(f"{day.root}/model_versions")
        return model.vocab, {"jobs_vectorized": n}

    return _run(day, "vectorize", work)


def export(day: Day, jobs: DataFrame) -> DataFrame:
    def work():
        batch = day.keep(tables.as_job_rows(jobs, day.now_col), "exported")
        required = ("job_id", "job_title")
        months = day.jobs.touched(batch, "job_id")
        held = day.jobs.read(months=months).drop(MONTH)
        counts = tables.upsert_counts(held, batch, required=required).collect()[0]
        day.jobs.rewrite(months, day.now_col, lambda rows: tables.upsert(rows, batch, required=required))
        return day.jobs.read().drop(MONTH), {
            "jobs_inserted": counts["inserted"],
            "jobs_updated": counts["updated"],
            "jobs_failed": counts["failed"],
        }

    return _run(day, "export", work)


def run_day(day: Day, landed: DataFrame, sample: DataFrame | None = None) -> DataFrame:
    """All five stages; returns the jobs table."""
    raw = collect(day, landed, sample)
    jobs = enrich(day, check(day, raw))
    vectorize(day, jobs)
    return export(day, jobs)
