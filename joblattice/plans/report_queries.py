"""Queries of the views and reports; orders stand for the log of stage runs and for dated listings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from joblattice.constants import STAGE_ALERT_SECONDS, STAGE_SLA_SECONDS, STAGES
from joblattice.operators import reports, search
from joblattice.operators import runs as run_log
from joblattice.operators.rows import align_schema
from joblattice.plans.catalog import Tables, query
from joblattice.schemas import BATCH_RUNS

AS_OF_SQL = "DATE '2001-08-02'"


def as_of():
    return F.lit("2001-08-02").cast("date")


# --- listings --------------------------------------------------------------------------------------

_PLACES = ["Paris", "Lyon", "Marseille", "Lille", "Saint-Denis"]
_TITLES = ["Python Developer", "Data Engineer", "Senior Python Engineer", "Analyst"]

JOBS_SQL = f"""
SELECT CAST(o_orderkey AS VARCHAR) AS job_id,
    ({_TITLES!r})[CAST(o_orderkey % 4 AS INTEGER) + 1] AS job_title,
    'Customer ' || o_custkey AS company_name,
    ({_PLACES!r})[CAST(o_custkey % 5 AS INTEGER) + 1] AS location,
    CAST(o_orderdate AS DATE) AS posted_date,
    CASE WHEN o_orderstatus <> 'P' THEN 'Order of ' || o_custkey END AS job_description,
    CASE WHEN o_orderpriority <> '5-LOW' THEN lower(o_orderpriority) END AS skills_required,
    CASE WHEN o_totalprice > 100000 THEN CAST(floor(o_totalprice / 10) AS BIGINT) END AS salary_min,
    CASE WHEN o_totalprice > 100000 THEN CAST(floor(o_totalprice / 5) AS BIGINT) END AS salary_max,
    o_totalprice > 100000 AS has_salary, o_orderpriority <> '5-LOW' AS has_skills,
    o_orderpriority AS source, (o_orderkey % 11) / 10.0 AS data_quality_score
FROM orders"""


def jobs(t: Tables) -> DataFrame:
    pick = lambda words, c: F.element_at(F.array(*[F.lit(w) for w in words]), (c % len(words)).cast("int") + 1)
    key, customer, price = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_totalprice")
    paid, skilled = price > 100000, F.col("o_orderpriority") != "5-LOW"
    return t.orders.select(
        key.cast("string").alias("job_id"),
        pick(_TITLES, key).alias("job_title"),
        F.concat(F.lit("Customer "), customer.cast("string")).alias("company_name"),
        pick(_PLACES, customer).alias("location"),
        F.to_date("o_orderdate").alias("posted_date"),
        F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("Order of "), customer.cast("string"))).alias("job_description"),
        F.when(skilled, F.lower("o_orderpriority")).alias("skills_required"),
        F.when(paid, F.floor(price / 10)).alias("salary_min"),
        F.when(paid, F.floor(price / 5)).alias("salary_max"),
        paid.alias("has_salary"),
        skilled.alias("has_skills"),
        F.col("o_orderpriority").alias("source"),
        ((key % 11) / 10.0).alias("data_quality_score"),
    )


_RECENT = f"""
WITH jobs AS ({JOBS_SQL})
SELECT job_id, job_title, company_name, location, posted_date, salary_min, salary_max, skills_required,
    CAST(date_diff('day', posted_date, {AS_OF_SQL}) AS INTEGER) AS days_since_posted
FROM jobs WHERE posted_date >= {AS_OF_SQL} - INTERVAL 7 DAY"""


@query(_RECENT)
def recent_rows(t: Tables) -> DataFrame:
    return reports.recent_jobs(jobs(t), as_of())


@query(f"{_RECENT.replace('7 DAY', '400 DAY')} ORDER BY posted_date DESC, job_id LIMIT 50")
def recent_newest_50(t: Tables) -> DataFrame:
    return reports.newest_recent_jobs(jobs(t), as_of(), days=400)


_COMPLETE = "job_title IS NOT NULL AND job_description IS NOT NULL AND has_salary AND has_skills"


@query(f"""WITH jobs AS ({JOBS_SQL})
SELECT job_id, job_title, company_name, location, job_description, skills_required, salary_min, salary_max FROM jobs WHERE {_COMPLETE}""")
def complete_rows(t: Tables) -> DataFrame:
    return reports.complete_jobs(jobs(t))


@query(f"WITH jobs AS ({JOBS_SQL}) SELECT count(*) AS complete_jobs FROM jobs WHERE {_COMPLETE}")
def complete_count(t: Tables) -> DataFrame:
    return reports.count_complete(jobs(t))


@query(f"""WITH jobs AS ({JOBS_SQL})
SELECT job_id, job_title, company_name, salary_min, salary_max, skills_required FROM jobs
WHERE has_salary AND has_skills ORDER BY posted_date DESC, job_id LIMIT 100""")
def complete_newest_100(t: Tables) -> DataFrame:
    return reports.newest_with_salary_and_skills(jobs(t))


@query(f"""WITH jobs AS ({JOBS_SQL})
SELECT source, count(*) AS total, count(*) FILTER (WHERE has_salary) AS with_salary, count(*) FILTER (WHERE has_skills) AS with_skills,
    round(avg(CAST(data_quality_score AS DOUBLE)), 2) AS avg_quality
FROM jobs GROUP BY source""")
def source_quality(t: Tables) -> DataFrame:
    return reports.source_quality(jobs(t))


@query(f"""WITH jobs AS ({JOBS_SQL})
SELECT job_id, job_title, company_name, location, salary_min, salary_max FROM jobs
WHERE job_title ILIKE '%python%' AND location ILIKE '%PARIS%' AND posted_date >= {AS_OF_SQL} - INTERVAL 14 DAY""")
def search_ilike(t: Tables) -> DataFrame:
    hits = search.search(jobs(t), as_of(), 14, job_title="python", location="PARIS")
    return hits.select("job_id", "job_title", "company_name", "location", "salary_min", "salary_max")


# --- stage runs ------------------------------------------------------------------------------------

RUNS_SQL = f"""
SELECT CAST(o_custkey AS VARCHAR) AS batch_id, CAST(o_orderdate AS DATE) AS batch_date,
    ({STAGES!r})[CAST(left(o_orderpriority, 1) AS INTEGER)] AS stage,
    CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'O' THEN 'success' ELSE 'in_progress' END AS status,
    CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderkey % 3 ELSE 0 END AS jobs_collected,
    CASE WHEN o_orderpriority = '2-HIGH' THEN o_orderkey % 3 ELSE 0 END AS jobs_validated,
    CASE WHEN o_orderpriority = '3-MEDIUM' THEN o_orderkey % 3 ELSE 0 END AS jobs_enriched,
    CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN o_orderkey % 3 ELSE 0 END AS jobs_vectorized,
    CASE WHEN o_orderpriority = '5-LOW' THEN o_orderkey % 2 ELSE 0 END AS jobs_inserted,
    CASE WHEN o_orderpriority = '5-LOW' THEN o_orderkey % 5 ELSE 0 END AS jobs_updated,
    CASE WHEN o_orderstatus = 'F' THEN o_orderkey % 2 ELSE 0 END AS jobs_failed,
    CASE WHEN o_orderstatus = 'F' THEN 'order ' || o_orderkey END AS error_message,
    CAST(floor(o_totalprice / 1000) AS INTEGER) AS execution_time_seconds,
    o_orderdate + to_seconds(o_orderkey) AS created_at, o_orderdate + to_seconds(o_orderkey + o_custkey) AS updated_at
FROM orders"""


def runs(t: Tables) -> DataFrame:
    key, priority, status = F.col("o_orderkey"), F.col("o_orderpriority"), F.col("o_orderstatus")
    start = F.col("o_orderdate").cast("timestamp")
    later = lambda seconds: F.timestamp_add("SECOND", seconds, start)
    counter = lambda p, k: F.when(priority == p, key % k).otherwise(0)
    return t.orders.select(
        F.col("o_custkey").cast("string").alias("batch_id"),
        F.to_date("o_orderdate").alias("batch_date"),
        F.element_at(F.array(*[F.lit(s) for s in STAGES]), F.left(priority, F.lit(1)).cast("int")).alias("stage"),
        F.when(status == "F", "failed").when(status == "O", "success").otherwise("in_progress").alias("status"),
        counter("1-URGENT", 3).alias("jobs_collected"),
        counter("2-HIGH", 3).alias("jobs_validated"),
        counter("3-MEDIUM", 3).alias("jobs_enriched"),
        counter("4-NOT SPECIFIED", 3).alias("jobs_vectorized"),
        counter("5-LOW", 2).alias("jobs_inserted"),
        counter("5-LOW", 5).alias("jobs_updated"),
        F.when(status == "F", key % 2).otherwise(0).alias("jobs_failed"),
        F.when(status == "F", F.concat(F.lit("order "), key.cast("string"))).alias("error_message"),
        F.floor(F.col("o_totalprice") / 1000).cast("int").alias("execution_time_seconds"),
        later(key).alias("created_at"),
        later(key + F.col("o_custkey")).alias("updated_at"),
    )


def _runs_sql(select: str) -> str:
    return f"WITH runs AS ({RUNS_SQL}) {select}"


def _since(days: int) -> str:
    return f"batch_date >= {AS_OF_SQL} - INTERVAL {days} DAY"


@query(_runs_sql(f"""
SELECT batch_date, count(*) AS total_stages, count(*) FILTER (WHERE status = 'success') AS successful,
    count(*) FILTER (WHERE status = 'failed') AS failed, CAST(sum(jobs_inserted) + sum(jobs_updated) AS BIGINT) AS total_processed
FROM runs WHERE {_since(30)} GROUP BY batch_date"""))
def daily_stats(t: Tables) -> DataFrame:
    return reports.daily_statistics(runs(t), as_of(), folded=True)


@query(_runs_sql(f"""
SELECT stage, count(*) AS runs, round(avg(execution_time_seconds), 2) AS avg_seconds, min(execution_time_seconds) AS min_seconds,
    max(execution_time_seconds) AS max_seconds
FROM runs WHERE status = 'success' AND {_since(30)} GROUP BY stage"""))
def stage_timing(t: Tables) -> DataFrame:
    return reports.stage_timing(runs(t), as_of())


@query(_runs_sql(f"""
SELECT stage, count(*) AS total_runs, count(*) FILTER (WHERE status = 'failed') AS failed_runs,
    round(CAST(100.0 AS DOUBLE) * count(*) FILTER (WHERE status = 'failed') / count(*), 2) AS failure_rate
FROM runs WHERE {_since(90)} GROUP BY stage"""))
def failure_rate(t: Tables) -> DataFrame:
    return reports.failure_rate(runs(t), as_of(), folded=True)


@query(_runs_sql(f"""
SELECT batch_date, count(*) AS total_runs, count(*) FILTER (WHERE status = 'success') AS successful,
    round(CAST(100.0 AS DOUBLE) * count(*) FILTER (WHERE status = 'success') / count(*), 1) AS success_rate
FROM runs WHERE {_since(7)} GROUP BY batch_date"""))
def success_rate(t: Tables) -> DataFrame:
    return reports.success_rate(runs(t), as_of(), folded=True)


# The same reports over a log that holds several states of a run.


def _folded_sql(select: str) -> str:
    return _runs_sql(f""", folded AS (SELECT * FROM runs QUALIFY row_number() OVER
    (PARTITION BY batch_id, stage ORDER BY updated_at DESC, status <> 'in_progress' DESC) = 1) {select}""")


@query(_folded_sql(f"""
SELECT batch_date, count(*) AS total_stages, count(*) FILTER (WHERE status = 'success') AS successful,
    count(*) FILTER (WHERE status = 'failed') AS failed, CAST(sum(jobs_inserted) + sum(jobs_updated) AS BIGINT) AS total_processed
FROM folded WHERE {_since(30)} GROUP BY batch_date"""))
def daily_stats_log(t: Tables) -> DataFrame:
    return reports.daily_statistics(runs(t), as_of())


@query(_folded_sql(f"""
SELECT stage, count(*) AS total_runs, count(*) FILTER (WHERE status = 'failed') AS failed_runs,
    round(CAST(100.0 AS DOUBLE) * count(*) FILTER (WHERE status = 'failed') / count(*), 2) AS failure_rate
FROM folded WHERE {_since(90)} GROUP BY stage"""))
def failure_rate_log(t: Tables) -> DataFrame:
    return reports.failure_rate(runs(t), as_of())


@query(_folded_sql(f"""
SELECT batch_date, count(*) AS total_runs, count(*) FILTER (WHERE status = 'success') AS successful,
    round(CAST(100.0 AS DOUBLE) * count(*) FILTER (WHERE status = 'success') / count(*), 1) AS success_rate
FROM folded WHERE {_since(7)} GROUP BY batch_date"""))
def success_rate_log(t: Tables) -> DataFrame:
    return reports.success_rate(runs(t), as_of())


@query(_runs_sql("""
SELECT batch_id, batch_date, stage, status, jobs_collected, jobs_enriched, jobs_inserted, execution_time_seconds, created_at FROM runs
ORDER BY created_at DESC, batch_id DESC, stage DESC LIMIT 1"""))
def last_run(t: Tables) -> DataFrame:
    return reports.last_run(runs(t))


@query(_runs_sql("""
SELECT batch_id, batch_date, stage, status, jobs_inserted, jobs_updated, jobs_failed, execution_time_seconds, created_at
FROM runs ORDER BY created_at DESC, batch_id, stage LIMIT 1"""))
def latest_run(t: Tables) -> DataFrame:
    return reports.latest_batch_status(runs(t))


@query(_runs_sql("""
SELECT batch_id, batch_date, stage, status, error_message, updated_at FROM runs WHERE status = 'failed'
ORDER BY updated_at DESC, batch_id, stage LIMIT 10"""))
def failed_runs(t: Tables) -> DataFrame:
    return reports.failed_runs(runs(t))


@query(_runs_sql("""
SELECT batch_id, batch_date, stage, status, error_message, created_at FROM runs WHERE status = 'failed'
ORDER BY created_at DESC, batch_id, stage LIMIT 1"""))
def last_failed_run(t: Tables) -> DataFrame:
    return reports.failed_runs(runs(t), 1, by="created_at")


@query(_runs_sql("""
, totals AS (SELECT batch_id, max(jobs_collected) AS c, max(jobs_validated) AS v, max(jobs_enriched) AS e, max(jobs_vectorized) AS z,
    max(jobs_inserted) AS i, max(jobs_updated) AS u FROM runs GROUP BY batch_id)
SELECT batch_id, c > 0 AS collect_ok, v >= 0.9 * c AS validate_ok, e = v AS enrich_ok, z = e AS vectorize_ok, i + u = e AS export_ok FROM totals"""))
def stage_success(t: Tables) -> DataFrame:
    return reports.stage_criteria(runs(t))


@query(_runs_sql("""
SELECT batch_id, stage, arg_max(status, (updated_at, status <> 'in_progress', error_message)) AS status, max(updated_at) AS updated_at,
    min(created_at) AS created_at FROM runs GROUP BY batch_id, stage"""))
def current_runs(t: Tables) -> DataFrame:
    """The log folded to the last state of every batch and stage."""
    folded = run_log.current_runs(align_schema(runs(t), BATCH_RUNS))
    return folded.select("batch_id", "stage", "status", "updated_at", "created_at")


def _limits(limits: dict[str, int]) -> str:
    return "CASE stage " + " ".join(f"WHEN '{s}' THEN {n}" for s, n in limits.items()) + " END"


@query(_runs_sql(f"""
, timed AS (SELECT batch_id, stage, execution_time_seconds, {_limits(STAGE_SLA_SECONDS)} AS sla_seconds, {_limits(STAGE_ALERT_SECONDS)} AS alert_seconds FROM runs)
SELECT *, execution_time_seconds > sla_seconds AS breached FROM timed WHERE execution_time_seconds > alert_seconds"""))
def sla_breaches(t: Tables) -> DataFrame:
    return reports.sla_breaches(runs(t))


@query(_runs_sql("""
, totals AS (SELECT batch_id, count(DISTINCT stage) FILTER (WHERE status = 'success') AS stages_done,
    CAST(sum(jobs_inserted) + sum(jobs_updated) AS BIGINT) AS processed, CAST(sum(jobs_failed) AS BIGINT) AS failed,
    CAST(sum(jobs_enriched) AS BIGINT) AS enriched, CAST(sum(execution_time_seconds) AS BIGINT) AS total_seconds FROM runs GROUP BY batch_id)
SELECT *, NOT (failed = 0 OR failed < 0.05 * enriched) AS failed_share_alert, total_seconds > 720 AS time_alert, total_seconds >= 900 AS sla_breached,
    stages_done = 5 AND processed > 0 AND (failed = 0 OR failed < 0.05 * enriched) AND total_seconds < 900 AS batch_ok
FROM totals"""))
def batch_health(t: Tables) -> DataFrame:
    return reports.batch_health(runs(t))


# --- model versions -----------------------------------------------------------------------------------

VERSIONS_SQL = """
SELECT 'tfidf_v' || o_orderkey AS model_version, 'vocab/' || o_orderkey AS vectorizer_path, 'postings/' || o_orderkey AS matrix_path,
    CASE o_orderstatus WHEN 'F' THEN 'deprecated' WHEN 'O' THEN 'active' ELSE 'archived' END AS status,
    o_orderdate AS created_at, 'batch_' || o_custkey AS created_by, o_orderdate AS updated_at, CAST(floor(o_totalprice) AS BIGINT) AS trained_on_jobs_count
FROM orders"""


def versions(t: Tables) -> DataFrame:
    key = F.col("o_orderkey").cast("string")
    status, made = F.col("o_orderstatus"), F.col("o_orderdate").cast("timestamp")
    return t.orders.select(
        F.concat(F.lit("tfidf_v"), key).alias("model_version"),
        F.concat(F.lit("vocab/"), key).alias("vectorizer_path"),
        F.concat(F.lit("postings/"), key).alias("matrix_path"),
        F.when(status == "F", "deprecated").when(status == "O", "active").otherwise("archived").alias("status"),
        made.alias("created_at"),
        F.concat(F.lit("batch_"), F.col("o_custkey").cast("string")).alias("created_by"),
        made.alias("updated_at"),
        F.floor("o_totalprice").alias("trained_on_jobs_count"),
    )


@query(f"""WITH versions AS ({VERSIONS_SQL})
SELECT model_version, vectorizer_path, matrix_path FROM versions WHERE status = 'active' ORDER BY created_at DESC, model_version DESC LIMIT 1""")
def active_model(t: Tables) -> DataFrame:
    return reports.active_model(versions(t))


@query(f"WITH versions AS ({VERSIONS_SQL}) SELECT model_version, status, created_at, created_by, trained_on_jobs_count FROM versions")
def model_history(t: Tables) -> DataFrame:
    return reports.model_history(versions(t))


@query(f"""WITH versions AS ({VERSIONS_SQL}),
moved AS (SELECT *, CASE WHEN model_version = 'tfidf_v0' THEN 'active' WHEN status = 'active' THEN 'archived' ELSE status END AS next FROM versions)
SELECT model_version, next AS status, CASE WHEN next <> status THEN TIMESTAMP '2001-08-02' ELSE updated_at END AS updated_at FROM moved""")
def promote_model(t: Tables) -> DataFrame:
    moved = reports.promote_model(versions(t), "tfidf_v0", F.lit("2001-08-02").cast("timestamp"))
    return moved.select("model_version", "status", "updated_at")
