"""Views over listings and reports over the log of stage runs.

Dates are relative to ``as_of``, a date column the caller gives, so that a report can be repeated.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from joblattice.constants import (
    STAGE_ALERT_SECONDS,
    STAGE_SLA_SECONDS,
    STAGES,
    TOTAL_ALERT_SECONDS,
    TOTAL_SLA_SECONDS,
)
from joblattice.functions.values import days_since
from joblattice.operators.runs import last_states


def since(column: str, as_of: Column, days: int) -> Column:
    return F.col(column) >= F.date_sub(as_of, days)


# --- listings ----------------------------------------------------------------------------------


def recent_jobs(jobs: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Listings of the last ``days``, newest first, with their age at ``as_of``."""
    aged = jobs.filter(since("posted_date", as_of, days)).withColumn(
        "days_since_posted", days_since(F.col("posted_date"), as_of)
    )
    return aged.select(
        "job_id", "job_title", "company_name", "location", "posted_date", "salary_min", "salary_max",
        "skills_required", "days_since_posted",
    ).orderBy(F.desc("posted_date"), "job_id")


def newest_recent_jobs(jobs: DataFrame, as_of: Column, days: int = 7, n: int = 50) -> DataFrame:
    return recent_jobs(jobs, as_of, days).limit(n)


def complete_jobs(jobs: DataFrame) -> DataFrame:
    """Listings with title, description, salary and skills."""
    full = F.col("job_title").isNotNull() & F.col("job_description").isNotNull() & F.col("has_salary") & F.col("has_skills")
    return jobs.filter(full).select(
        "job_id", "job_title", "company_name", "location", "job_description", "skills_required",
        "salary_min", "salary_max",
    )


def count_complete(jobs: DataFrame) -> DataFrame:
    return complete_jobs(jobs).agg(F.count(F.lit(1)).alias("complete_jobs"))


def newest_with_salary_and_skills(jobs: DataFrame, n: int = 100) -> DataFrame:
    return (
        jobs.filter(F.col("has_salary") & F.col("has_skills"))
        .orderBy(F.desc("posted_date"), "job_id")
        .limit(n)
        .select("job_id", "job_title", "company_name", "salary_min", "salary_max", "skills_required")
    )


def source_quality(jobs: DataFrame) -> DataFrame:
    """Totals, filled fields and mean quality per source, largest first."""
    return (
        jobs.groupBy("source")
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.count_if("has_salary").alias("with_salary"),
            F.count_if("has_skills").alias("with_skills"),
            F.round(F.avg("data_quality_score"), 2).alias("avg_quality"),
        )
        .orderBy(F.desc("total"), "source")
    )


def jobs_and_runs_by_day(jobs: DataFrame, runs: DataFrame, created: str = "created_at") -> DataFrame:
    """Listings created per day beside that day's stage runs; both sides are summed before they meet."""
    created_per_day = jobs.groupBy(F.to_date(created).alias("batch_date")).agg(F.count(F.lit(1)).alias("jobs_created"))
    runs_per_day = runs.groupBy("batch_date").agg(
        F.count_distinct("batch_id").alias("batches"),
        F.count_if(F.col("status") == "success").alias("successful"),
        F.count_if(F.col("status") == "failed").alias("failed"),
    )
    return created_per_day.join(runs_per_day, "batch_date")


# --- stage runs --------------------------------------------------------------------------------


def _status(name: str) -> Column:
    return F.count_if(F.col("status") == name)


def _one_row_a_run(runs: DataFrame, folded: bool) -> DataFrame:
    """A run log as it is written holds several rows a run; ``folded`` says that the caller has folded it."""
    return runs if folded else last_states(runs)


def daily_statistics(runs: DataFrame, as_of: Column, days: int = 30, folded: bool = False) -> DataFrame:
    processed = F.sum("jobs_inserted") + F.sum("jobs_updated")
    return (
        _one_row_a_run(runs, folded).filter(since("batch_date", as_of, days))
        .groupBy("batch_date")
        .agg(
            F.count(F.lit(1)).alias("total_stages"),
            _status("success").alias("successful"),
            _status("failed").alias("failed"),
            processed.alias("total_processed"),
        )
        .orderBy(F.desc("batch_date"))
    )


def stage_timing(runs: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    """Run time of successful runs per stage, slowest first."""
    return (
        runs.filter((F.col("status") == "success") & since("batch_date", as_of, days))
        .groupBy("stage")
        .agg(
            F.count(F.lit(1)).alias("runs"),
            F.round(F.avg("execution_time_seconds"), 2).alias("avg_seconds"),
            F.min("execution_time_seconds").alias("min_seconds"),
            F.max("execution_time_seconds").alias("max_seconds"),
        )
        .orderBy(F.desc("avg_seconds"), "stage")
    )


def failure_rate(runs: DataFrame, as_of: Column, days: int = 90, folded: bool = False) -> DataFrame:
    return (
        _one_row_a_run(runs, folded).filter(since("batch_date", as_of, days))
        .groupBy("stage")
        .agg(F.count(F.lit(1)).alias("total_runs"), _status("failed").alias("failed_runs"))
        .withColumn("failure_rate", F.round(100.0 * F.col("failed_runs") / F.col("total_runs"), 2))
        .orderBy(F.desc("failure_rate"), "stage")
    )


def success_rate(runs: DataFrame, as_of: Column, days: int = 7, folded: bool = False) -> DataFrame:
    return (
        _one_row_a_run(runs, folded).filter(since("batch_date", as_of, days))
        .groupBy("batch_date")
        .agg(F.count(F.lit(1)).alias("total_runs"), _status("success").alias("successful"))
        .withColumn("success_rate", F.round(100.0 * F.col("successful") / F.col("total_runs"), 1))
        .orderBy(F.desc("batch_date"))
    )


RUN_KEY = ("batch_id", "stage")


def latest_batch_status(runs: DataFrame) -> DataFrame:
    """The newest run."""
    return (
        runs.orderBy(F.desc("created_at"), *RUN_KEY)
        .limit(1)
        .select(
            "batch_id", "batch_date", "stage", "status", "jobs_inserted", "jobs_updated", "jobs_failed",
            "execution_time_seconds", "created_at",
        )
    )


def last_run(runs: DataFrame) -> DataFrame:
    """The run created last, with what it has collected, enriched and inserted; no row for an empty log."""
    order = F.struct("created_at", *RUN_KEY)
    newest = F.struct(
        "batch_id", "batch_date", "stage", "status", "jobs_collected", "jobs_enriched", "jobs_inserted",
        "execution_time_seconds", "created_at",
    )
    return runs.agg(F.max_by(newest, order).alias("run")).where("run is not null").select("run.*")


def failed_runs(runs: DataFrame, n: int = 10, by: str = "updated_at") -> DataFrame:
    """The last ``n`` failed runs."""
    return (
        runs.filter(F.col("status") == "failed")
        .orderBy(F.desc(by), *RUN_KEY)
        .limit(n)
        .select("batch_id", "batch_date", "stage", "status", "error_message", by)
    )


def stage_criteria(runs: DataFrame) -> DataFrame:
    """Per batch, whether each stage handed on what it should; one pass, one row per batch."""
    count = {
        name: F.coalesce(F.max(name), F.lit(0))
        for name in (
            "jobs_collected", "jobs_validated", "jobs_enriched", "jobs_vectorized", "jobs_inserted", "jobs_updated",
        )
    }
    totals = runs.groupBy("batch_id").agg(*[c.alias(n) for n, c in count.items()])
    col = F.col
    return totals.select(
        "batch_id",
        (col("jobs_collected") > 0).alias("collect_ok"),
        (col("jobs_validated") >= 0.9 * col("jobs_collected")).alias("validate_ok"),
        (col("jobs_enriched") == col("jobs_validated")).alias("enrich_ok"),
        (col("jobs_vectorized") == col("jobs_enriched")).alias("vectorize_ok"),
        (col("jobs_inserted") + col("jobs_updated") == col("jobs_enriched")).alias("export_ok"),
    )


def _limit_for(stage: Column, limits: Mapping[str, int]) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in limits.items() for x in pair]), stage)


def sla_breaches(
    runs: DataFrame,
    sla: Mapping[str, int] = STAGE_SLA_SECONDS,
    alert: Mapping[str, int] = STAGE_ALERT_SECONDS,
) -> DataFrame:
    """Runs slower than their stage's alert time, with ``breached`` where they pass the agreed one."""
    seconds = F.col("execution_time_seconds")
    timed = runs.select("batch_id", "stage", "execution_time_seconds").filter(F.col("stage").isin(*sla))
    slow = timed.withColumns({"sla_seconds": _limit_for(F.col("stage"), sla), "alert_seconds": _limit_for(F.col("stage"), alert)})
    return slow.filter(seconds > F.col("alert_seconds")).withColumn("breached", seconds > F.col("sla_seconds"))


def batch_health(
    runs: DataFrame,
    total_sla: int = TOTAL_SLA_SECONDS,
    total_alert: int = TOTAL_ALERT_SECONDS,
    max_failed_share: float = 0.05,
) -> DataFrame:
    """Per batch: all stages done, rows processed, failed share, total time and the verdict on them."""
    done = F.count_distinct(F.when(F.col("status") == "success", F.col("stage")))
    totals = runs.filter(F.col("stage").isin(*STAGES)).groupBy("batch_id").agg(
        done.alias("stages_done"),
        F.coalesce(F.sum("jobs_inserted") + F.sum("jobs_updated"), F.lit(0)).alias("processed"),
        F.coalesce(F.sum("jobs_failed"), F.lit(0)).alias("failed"),
        F.coalesce(F.sum("jobs_enriched"), F.lit(0)).alias("enriched"),
        F.coalesce(F.sum("execution_time_seconds"), F.lit(0)).alias("total_seconds"),
    )
    few_failed = (F.col("failed") == 0) | (F.col("failed") < max_failed_share * F.col("enriched"))
    in_time = F.col("total_seconds") < total_sla
    return totals.withColumns(
        {
            "failed_share_alert": ~few_failed,
            "time_alert": F.col("total_seconds") > total_alert,
            "sla_breached": ~in_time,
            "batch_ok": (F.col("stages_done") == len(STAGES)) & (F.col("processed") > 0) & few_failed & in_time,
        }
    )


# --- model versions ----------------------------------------------------------------------------


def active_model(versions: DataFrame) -> DataFrame:
    """The newest active model version."""
    return (
        versions.filter(F.col("status") == "active")
        .orderBy(F.desc("created_at"), F.desc("model_version"))
        .limit(1)
        .select("model_version", "vectorizer_path", "matrix_path")
    )


def model_history(versions: DataFrame) -> DataFrame:
    return versions.select(
        "model_version", "status", "created_at", "created_by", "trained_on_jobs_count"
    ).orderBy(F.desc("created_at"), F.desc("model_version"))


def promote_model(versions: DataFrame, model_version: str, now: Column, retired: str = "archived") -> DataFrame:
    """``model_version`` made active and every other active one set to ``retired``; also the way back."""
    chosen = F.col("model_version") == model_version
    status = F.when(chosen, "active").when(F.col("status") == "active", retired).otherwise(F.col("status"))
    return set_status(versions, status, now)


def set_model_status(versions: DataFrame, model_version: str, status: str, now: Column) -> DataFrame:
    changed = F.when(F.col("model_version") == model_version, status).otherwise(F.col("status"))
    return set_status(versions, changed, now)


def set_status(versions: DataFrame, status: Column, now: Column) -> DataFrame:
    """Statuses replaced; ``updated_at`` moves only where one changed."""
    moved = status != F.col("status")
    return versions.withColumns({"status": status, "updated_at": F.when(moved, now).otherwise(F.col("updated_at"))})
