"""Queries of the row operators: collection, de-duplication, validation, cleaning, table maintenance."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from joblattice.constants import RAW_COLUMNS
from joblattice.functions import values
from joblattice.operators import clean, reports, rows, runs, tables, validate
from joblattice.plans import daily
from joblattice.plans.catalog import Tables, query, sql_clean_text
from joblattice.plans.text_queries import sql_keyword_skills
from joblattice.schemas import API_PAGE, RAW_JOBS
from joblattice.session import scratch_path, written
from joblattice.sources import files, pages

# --- raw listings made of the documents: the text's hash is the id, so copies share one --------------

WORDS = ["The", "Of the", "Que", "Und", "Der", "De la"]

RAW_SQL = """
SELECT md5(text) AS job_id, doc_id AS _seq,
    CASE WHEN n_chars % 17 = 0 THEN ' <i> </i> ' ELSE '<b>' || source || '</b>  senior' || chr(10) || lang || ' writer' END AS job_title,
    CASE WHEN n_chars % 13 = 0 THEN NULL ELSE ' ' || source || ' ' END AS company_name,
    CASE WHEN n_chars % 11 = 0 THEN ' ' ELSE lang || '-sur-' || source || ' ' || (n_chars % 20) || 'er (' || lang || ')' END AS location,
    CASE WHEN n_chars % 19 = 0 THEN 'soon' ELSE strftime(DATE '2024-01-01' + CAST(doc_id % 365 AS INTEGER), '%Y-%m-%d') END AS posted_date,
    text AS job_description,
    CASE WHEN n_chars % 3 = 0 THEN NULL WHEN n_chars % 7 = 0 THEN 'Competitive'
        ELSE (20 + n_chars % 50) || ' 000 - ' || (60 + n_chars % 40) || ' 500 EUR' END AS salary_range,
    CASE WHEN n_chars % 23 = 0 THEN '' WHEN n_chars % 22 = 0 THEN 'ftp://jobs.example/' || doc_id ELSE 'http://jobs.example/' || doc_id END AS url,
    source, lang AS search_query,
    CAST(n_chars % 41 AS VARCHAR) AS salary_min,
    CASE WHEN n_chars % 29 = 0 THEN 'high' ELSE CAST(n_chars % 43 AS VARCHAR) END AS salary_max
FROM documents
"""


def raw_listings(t: Tables, salaries: bool = True) -> DataFrame:
    n, text = F.col("n_chars"), lambda c: c.cast("string")
    every = lambda k: n % k == 0
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 365).cast("int"))
    columns = {
        "job_id": F.md5("text"),
        "_seq": F.col("doc_id"),
        "job_title": F.when(every(17), " <i> </i> ").otherwise(
            F.concat(F.lit("<b>"), F.col("source"), F.lit("</b>  senior\n"), F.col("lang"), F.lit(" writer"))
        ),
        "company_name": F.when(~every(13), F.concat(F.lit(" "), F.col("source"), F.lit(" "))),
        "location": F.when(every(11), " ").otherwise(
            F.concat(F.col("lang"), F.lit("-sur-"), F.col("source"), F.lit(" "), text(n % 20), F.lit("er ("), F.col("lang"), F.lit(")"))
        ),
        "posted_date": F.when(every(19), "soon").otherwise(F.date_format(day, "yyyy-MM-dd")),
        "job_description": F.col("text"),
        "salary_range": F.when(every(3), F.lit(None).cast("string"))
        .when(every(7), "Competitive")
        .otherwise(F.concat(text(20 + n % 50), F.lit(" 000 - "), text(60 + n % 40), F.lit(" 500 EUR"))),
        "url": F.when(every(23), "").otherwise(
            F.concat(F.when(every(22), "ftp").otherwise("http"), F.lit("://jobs.example/"), text(F.col("doc_id")))
        ),
        "source": F.col("source"),
        "search_query": F.col("lang"),
    }
    if salaries:
        columns["salary_min"] = text(n % 41)
        columns["salary_max"] = F.when(every(29), "high").otherwise(text(n % 43))
    return t.documents.select([c.alias(name) for name, c in columns.items()])


# --- first rows, append ------------------------------------------------------------------------------


@query("SELECT md5(text) AS job_id, min(doc_id) AS doc_id FROM documents GROUP BY md5(text)")
def dedup_keep_first(t: Tables) -> DataFrame:
    keyed = t.documents.select(F.md5("text").alias("job_id"), "doc_id")
    return rows.keep_first(keyed, ["job_id"], "doc_id")


_HALVES = "WITH keyed AS (SELECT md5(text) AS job_id, doc_id AS _seq, source, length(source) = 4 AS old FROM documents)"


def _halves(t: Tables) -> tuple[DataFrame, DataFrame]:
    """One-digit sources stand for the stored rows, the others for the new ones."""
    keyed = t.documents.select(F.md5("text").alias("job_id"), F.col("doc_id").alias("_seq"), "source")
    old = F.length("source") == 4
    return keyed.filter(old), keyed.filter(~old)


@query(f"""{_HALVES}
SELECT job_id, _seq, source FROM (
    SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY old DESC, _seq) AS n FROM keyed) WHERE n = 1
""")
def append_dedup(t: Tables) -> DataFrame:
    return rows.append_dedup(*_halves(t))


@query(f"""{_HALVES}
SELECT count(*) - count(DISTINCT job_id) AS duplicates_removed,
    count(DISTINCT job_id) - CAST(count(*) FILTER (WHERE old) AS BIGINT) AS new_entries, count(DISTINCT job_id) AS total FROM keyed
""")
def append_stats(t: Tables) -> DataFrame:
    return rows.append_stats(*_halves(t))


@query("SELECT " + ", ".join(
    {"job_id": "CAST(doc_id AS VARCHAR)", "job_description": "text", "source": "source"}.get(c, "CAST(NULL AS VARCHAR)") + f" AS {c}"
    for c in RAW_COLUMNS) + " FROM documents")
def align_schema(t: Tables) -> DataFrame:
    named = t.documents.withColumnsRenamed({"doc_id": "job_id", "text": "job_description"})
    return rows.align_schema(named, RAW_JOBS)


# --- validation ----------------------------------------------------------------------------------------

_RULES = {
    "missing_title": "trim(job_title) = ''",
    "invalid_title_length": "trim(job_title) <> '' AND NOT length(job_title) BETWEEN 30 AND 500",
    "missing_url": "trim(url) = ''",
    "missing_location": "trim(location) = ''",
    "invalid_date": "posted_date = 'soon'",
    "invalid_salary": "coalesce(TRY_CAST(salary_min AS DOUBLE) > TRY_CAST(salary_max AS DOUBLE), true)",
}
_FAILED_SQL = "list_filter([" + ", ".join(f"CASE WHEN {rule} THEN '{name}' END" for name, rule in _RULES.items()) + "], lambda r: r IS NOT NULL)"
_CHECKED = f"WITH raw AS ({RAW_SQL}), checked AS (SELECT *, {_FAILED_SQL} AS failed FROM raw)"
_COUNTS_SQL = ", ".join(f"count(*) FILTER (WHERE {rule}) AS {name}" for name, rule in _RULES.items())

# A stricter title length than usual, so that the rule rejects some of the made-up titles.
FIELDS = validate.Fields(title_low=30)


def _checked(t: Tables) -> DataFrame:
    return validate.with_failed_rules(raw_listings(t), FIELDS)


@query(f"{_CHECKED} SELECT {_COUNTS_SQL}, count(*) FILTER (WHERE len(failed) = 0) AS valid_count, count(*) AS total FROM checked")
def validate_counts(t: Tables) -> DataFrame:
    return validate.rule_counts(raw_listings(t), FIELDS)


@query(f"""{_CHECKED}, counted AS (
    SELECT {_COUNTS_SQL}, count(*) FILTER (WHERE len(failed) = 0) AS valid_count, count(*) AS total FROM checked)
SELECT *, total - valid_count AS failed_count, round(100.0 * valid_count / total, 1) AS pass_rate FROM counted""")
def validate_report(t: Tables) -> DataFrame:
    return validate.validation_report(raw_listings(t), FIELDS)


@query(f"{_CHECKED} SELECT _seq, job_id, array_to_string(failed, ',') AS failed_rules FROM checked")
def validate_rows(t: Tables) -> DataFrame:
    return _checked(t).select("_seq", "job_id", F.array_join(validate.FAILED, ",").alias("failed_rules"))


@query(f"{_CHECKED} SELECT rule, count(*) AS rows FROM (SELECT unnest(failed) AS rule FROM checked) GROUP BY rule")
def reject_reasons(t: Tables) -> DataFrame:
    return validate.reject_reasons(_checked(t))


@query(f"{_CHECKED} SELECT _seq, job_id, url FROM checked WHERE job_id IN (SELECT job_id FROM checked WHERE len(failed) = 0)")
def keep_valid_keys(t: Tables) -> DataFrame:
    return validate.keep_by_valid_key(_checked(t)).select("_seq", "job_id", "url")


@query(f"""WITH raw AS ({RAW_SQL}), typed AS (
    SELECT *, TRY_CAST(salary_min AS DOUBLE) AS low, TRY_CAST(salary_max AS DOUBLE) AS high FROM raw)
SELECT _seq, CASE WHEN posted_date = 'soon' THEN '2025-01-01' ELSE posted_date END AS posted_date,
    CASE WHEN trim(location) = '' THEN 'Unknown' ELSE location END AS location,
    CASE WHEN low > high THEN high ELSE low END AS salary_min, CASE WHEN low > high THEN low ELSE high END AS salary_max
FROM typed""")
def validate_repair(t: Tables) -> DataFrame:
    mended = validate.repair(raw_listings(t), F.lit("2025-01-01").cast("date"), FIELDS)
    return mended.select("_seq", "posted_date", "location", "salary_min", "salary_max")


@query(f"""{_CHECKED} SELECT count(*) FILTER (WHERE trim(url) <> '' AND url NOT LIKE 'http%') AS invalid_url, count(*) AS total FROM checked""")
def validate_url_format(t: Tables) -> DataFrame:
    return validate.rule_counts(raw_listings(t), FIELDS, url_format=True).select("invalid_url", "total")


# --- cleaning ------------------------------------------------------------------------------------------

CLEAN_SQL = f"""
WITH raw AS ({RAW_SQL}),
firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY _seq) AS n FROM raw) WHERE n = 1),
texts AS (
    SELECT * REPLACE ({sql_clean_text('job_title')} AS job_title,
        coalesce({sql_clean_text('company_name')}, 'Unknown Company') AS company_name,
        {sql_clean_text('job_description')} AS job_description,
        TRY_CAST(posted_date AS DATE) AS posted_date,
        trim(regexp_replace(trim(regexp_replace(trim(location), '\\([^)]*\\)', '', 'g')), '\\s+\\d+(er|e|ème)?\\s*', ' ', 'g')) AS location)
    FROM firsts),
clean AS (
    SELECT job_id, job_title, company_name,
        coalesce(nullif(array_to_string(list_transform(regexp_extract_all(location, '([\\p{{L}}]+|[^\\p{{L}}]+)'),
            lambda r: upper(r[1]) || lower(r[2:])), ''), ''), 'Unknown Location') AS location,
        posted_date, CAST(date_diff('day', posted_date, DATE '2025-01-01') AS INTEGER) AS days_since_posted, job_description,
        {sql_keyword_skills('lower(job_description)', WORDS)} AS skills_required, salary_range,
        CAST(CASE WHEN salary_range LIKE '%000%' THEN left(salary_range, 2) || '000' END AS BIGINT) AS salary_min,
        CAST(CASE WHEN salary_range LIKE '%000%' THEN salary_range[10:11] || '500' END AS BIGINT) AS salary_max,
        salary_range IS NOT NULL AS has_salary, url, source, search_query
    FROM texts WHERE job_title IS NOT NULL)
"""
_CLEAN_SELECT = "SELECT * REPLACE (job_id AS job_id), skills_required IS NOT NULL AS has_skills FROM clean"


def clean_listings(t: Tables) -> DataFrame:
    return clean.clean_jobs(raw_listings(t, salaries=False), F.lit("2025-01-01").cast("date"), keywords=WORDS)


@query(f"{CLEAN_SQL} {_CLEAN_SELECT}")
def clean_jobs(t: Tables) -> DataFrame:
    return clean_listings(t)


@query(f"""{CLEAN_SQL}, flagged AS ({_CLEAN_SELECT})
SELECT count(*) AS rows, count(*) FILTER (WHERE has_salary) AS with_salary,
    round(100.0 * count(*) FILTER (WHERE has_salary) / count(*), 1) AS with_salary_pct,
    count(*) FILTER (WHERE has_skills) AS with_skills,
    round(100.0 * count(*) FILTER (WHERE has_skills) / count(*), 1) AS with_skills_pct,
    count(DISTINCT company_name) AS companies, count(DISTINCT location) AS locations, count(DISTINCT search_query) AS search_queries
FROM flagged""")
def clean_stats(t: Tables) -> DataFrame:
    return clean.cleaning_stats(clean_listings(t))


@query(f"""
WITH raw AS ({RAW_SQL}), firsts AS (SELECT job_id, count(*) AS n, arg_min({sql_clean_text('job_title')} IS NOT NULL, _seq) AS titled FROM raw GROUP BY job_id)
SELECT CAST(sum(n) AS BIGINT) AS initial_rows, CAST(sum(n) AS BIGINT) - count(*) AS duplicates_removed,
    count(*) FILTER (WHERE NOT titled) AS no_title_removed, count(*) FILTER (WHERE titled) AS final_rows FROM firsts""")
def clean_step_counts(t: Tables) -> DataFrame:
    return clean.cleaning_step_counts(raw_listings(t))


@query(f"""WITH raw AS ({RAW_SQL})
SELECT _seq, round(((company_name IS NOT NULL)::INT + (salary_range IS NOT NULL)::INT + (url IS NOT NULL)::INT) / 3.0, 6) AS quality, 1.0::DOUBLE AS stored
FROM raw""")
def quality_score(t: Tables) -> DataFrame:
    score = values.quality_score(["company_name", "salary_range", "url"])
    return raw_listings(t).select("_seq", F.round(score, 6).alias("quality"), values.default_quality_score().alias("stored"))


# --- landed pages: orders as hits, written as JSON text and read back --------------------------------------

_PAGE_SIZE = 50


def landed_pages(t: Tables) -> DataFrame:
    """Pages of up to 50 neighbouring orders as JSON, parsed with the page schema.

    A page's hits are one status and priority out of one key range, so no page outgrows that range.
    """
    hit = F.struct(
        F.col("o_orderkey").cast("string").alias("id"),
        F.concat(F.lit("Clerk of "), F.col("o_orderpriority")).alias("title"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created"),
        F.lit(None).cast("string").alias("description"),
        F.concat(F.lit("http://jobs.example/"), F.col("o_orderkey").cast("string")).alias("redirect_url"),
        F.struct(F.concat(F.lit("Customer "), F.col("o_custkey").cast("string")).alias("display_name")).alias("company"),
        F.struct(F.lower("o_orderpriority").alias("display_name")).alias("location"),
        F.col("o_totalprice").alias("salary_min"),
        (F.col("o_totalprice") * 1.25).alias("salary_max"),
        F.lit(None).cast("string").alias("salary_currency"),
    )
    found = t.orders.select(
        F.col("o_orderstatus").alias("query"),
        F.col("o_orderpriority").alias("location"),
        (F.floor(F.col("o_orderkey") / _PAGE_SIZE) + 1).cast("int").alias("page"),
        hit.alias("hit"),
    )
    grouped = found.groupBy("query", "location", "page").agg(F.array_sort(F.collect_list("hit"), _by_number).alias("results"))
    text = grouped.select(F.to_json(F.struct("query", "location", "page", "results")).alias("json"))
    return text.select(F.from_json("json", API_PAGE).alias("p")).select("p.*")


def _by_number(a, b):
    return (a["id"].cast("bigint") - b["id"].cast("bigint")).cast("int")


_FOUND = f"""
WITH found AS (SELECT *, CAST(floor(o_orderkey / {_PAGE_SIZE}) AS INTEGER) + 1 AS page,
    row_number() OVER (PARTITION BY o_orderstatus, o_orderpriority ORDER BY o_orderkey) AS place FROM orders)"""


@query(f"""{_FOUND},
digests AS (SELECT *, sha1(from_hex('6ba7b8119dad11d180b400c04fd430c8') || encode(concat_ws('||', 'adzuna', CAST(o_orderkey AS VARCHAR),
    'http://jobs.example/' || o_orderkey, 'Clerk of ' || o_orderpriority, 'Customer ' || o_custkey))) AS x FROM found)
SELECT substr(x, 1, 8) || '-' || substr(x, 9, 4) || '-5' || substr(x, 14, 3) || '-' ||
    lower(to_hex((CAST('0x' || substr(x, 17, 2) AS INTEGER) & 63) | 128)) || substr(x, 19, 2) || '-' || substr(x, 21, 12) AS job_id,
    'Clerk of ' || o_orderpriority AS job_title, 'Customer ' || o_custkey AS company_name, lower(o_orderpriority) AS location,
    strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS posted_date, CAST(NULL AS VARCHAR) AS job_description,
    CAST(NULL AS VARCHAR) AS skills_required,
    replace(format('{{:,}}', CAST(trunc(o_totalprice) AS BIGINT)), ',', ' ') || ' - ' ||
    replace(format('{{:,}}', CAST(trunc(o_totalprice * 1.25) AS BIGINT)), ',', ' ') || ' EUR' AS salary_range,
    'http://jobs.example/' || o_orderkey AS url, 'adzuna' AS source, o_orderstatus AS search_query
FROM digests""")
def api_flatten(t: Tables) -> DataFrame:
    return pages.unify_schema(pages.to_raw_rows(pages.explode_hits(landed_pages(t))))


@query(f"""{_FOUND},
holes AS (SELECT o_orderstatus, o_orderpriority, min(page) AS stop FROM found WHERE o_totalprice > 499000 GROUP BY ALL)
SELECT found.o_orderkey FROM found LEFT JOIN holes USING (o_orderstatus, o_orderpriority) WHERE stop IS NULL OR page < stop""")
def api_first_empty(t: Tables) -> DataFrame:
    """A page with an order above 499 000 counts as come back empty."""
    costly = F.exists("results", lambda h: h["salary_min"] > 499000)
    holed = landed_pages(t).withColumn("results", F.when(costly, F.array().cast(API_PAGE["results"].dataType)).otherwise(F.col("results")))
    hits = pages.explode_hits(pages.before_first_empty(holed))
    return hits.select(F.col("hit.id").cast("bigint").alias("o_orderkey"))


def _limited(t: Tables, limit: int) -> DataFrame:
    hits = pages.explode_hits(pages.limit_pages(landed_pages(t), limit))
    return hits.select(F.col("hit.id").cast("bigint").alias("o_orderkey"))


@query(f"{_FOUND} SELECT o_orderkey FROM found WHERE place <= 300")
def location_limit(t: Tables) -> DataFrame:
    return _limited(t, 300)


@query(f"{_FOUND} SELECT o_orderkey FROM found WHERE place <= 5000")
def location_limit_large(t: Tables) -> DataFrame:
    return _limited(t, 5000)


@query("""
SELECT event_id, event_type FROM (
    SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS n FROM events) WHERE n <= 1500""")
def first_events_per_type(t: Tables) -> DataFrame:
    kept = t.events.select("event_id", "event_type", "ts")
    return rows.first_per_key(kept, ["event_type"], [F.asc("ts"), F.asc("event_id")], 1500).drop("ts")


# --- table maintenance: customers as the stored table, orders as the batch ------------------------------------

_TARGET = "SELECT c_custkey, c_name, c_mktsegment AS segment, c_acctbal AS balance FROM customer"
_BATCH = """SELECT o_custkey + CASE WHEN o_orderkey % 5 = 0 THEN 1000000 ELSE 0 END AS c_custkey, 'batch ' || o_orderkey AS c_name, o_orderpriority AS segment, o_totalprice AS balance,
    o_orderkey AS _seq FROM orders"""


def _target(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", "c_name", F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"))


def _batch(t: Tables) -> DataFrame:
    return t.orders.select(
        (F.col("o_custkey") + F.when(F.col("o_orderkey") % 5 == 0, 1000000).otherwise(0)).alias("c_custkey"),
        F.concat(F.lit("batch "), F.col("o_orderkey").cast("string")).alias("c_name"),
        F.col("o_orderpriority").alias("segment"),
        F.col("o_totalprice").alias("balance"),
        F.col("o_orderkey").alias("_seq"),
    )


UPSERT_SQL = f"""
WITH target AS ({_TARGET}), batch AS ({_BATCH}),
folded AS (SELECT c_custkey, arg_min(c_name, _seq) AS c_name, arg_max(segment, _seq) AS segment, arg_max(balance, _seq) AS balance
    FROM batch GROUP BY c_custkey)
SELECT coalesce(t.c_custkey, f.c_custkey) AS c_custkey, coalesce(t.c_name, f.c_name) AS c_name,
    coalesce(f.segment, t.segment) AS segment, coalesce(f.balance, t.balance) AS balance
FROM target t FULL JOIN folded f ON t.c_custkey = f.c_custkey"""


@query(UPSERT_SQL)
def upsert_rows(t: Tables) -> DataFrame:
    return tables.upsert(_target(t), _batch(t), "c_custkey", "_seq", ["segment", "balance"])


@query(f"""
WITH target AS ({_TARGET}), batch AS ({_BATCH}),
fresh AS (SELECT DISTINCT c_custkey FROM batch WHERE c_custkey NOT IN (SELECT c_custkey FROM target))
SELECT (SELECT count(*) FROM fresh) AS inserted, (SELECT count(*) FROM batch) - (SELECT count(*) FROM fresh) AS updated, CAST(0 AS BIGINT) AS failed""")
def upsert_counts(t: Tables) -> DataFrame:
    return tables.upsert_counts(_target(t), _batch(t), "c_custkey")


@query("""
SELECT o_orderkey, CAST(o_orderdate AS DATE) < DATE '2000-08-02' AS archived FROM orders""")
def archive_split(t: Tables) -> DataFrame:
    dated = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("posted_date"))
    kept, old = tables.archive_split(dated, F.lit("2001-08-02").cast("date"))
    return (
        kept.withColumn("archived", F.lit(False)).unionByName(old.withColumn("archived", F.lit(True))).drop("posted_date")
    )


@query("""
WITH kept AS (SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'),
backup AS (SELECT o_orderkey, o_totalprice * 2 AS o_totalprice FROM orders WHERE o_orderstatus = 'F')
SELECT * FROM kept UNION ALL SELECT * FROM backup WHERE o_orderkey NOT IN (SELECT o_orderkey FROM kept)""")
def rollback_rows(t: Tables) -> DataFrame:
    jobs = t.orders.select("o_orderkey", "o_totalprice", "o_orderdate")
    backup = t.orders.filter(F.col("o_orderstatus") == "F").select("o_orderkey", (F.col("o_totalprice") * 2).alias("o_totalprice"), "o_orderdate")
    back = tables.rollback(jobs, F.lit("2000-01-01").cast("timestamp_ntz"), backup, "o_orderkey", "o_orderdate")
    return back.drop("o_orderdate")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)")
def delete_keys(t: Tables) -> DataFrame:
    costly = t.orders.filter(F.col("o_totalprice") > 400000).select(F.col("o_custkey").alias("c_custkey"))
    return tables.delete_keys(t.customer.select("c_custkey", "c_name"), costly, "c_custkey")


@query("SELECT CAST(doc_id AS VARCHAR) AS job_id, text AS job_description, source FROM documents")
def csv_round_trip(t: Tables) -> DataFrame:
    """Documents written as CSV and read back, line breaks, quotes and all."""
    path = scratch_path(t.spark, "csv")
    named = t.documents.select(F.col("doc_id").cast("string").alias("job_id"), F.col("text").alias("job_description"), "source")
    files.write_csv(named, path)
    return files.read_csv(t.spark, path).select("job_id", "job_description", "source")


@query("""
SELECT job_id, job_description, source FROM (SELECT CAST(doc_id AS VARCHAR) AS job_id, text AS job_description, source FROM documents UNION ALL
SELECT CAST(doc_id + 1000000000 AS VARCHAR), text, 'again' FROM documents WHERE doc_id % 2 = 1)""")
def csv_folder(t: Tables) -> DataFrame:
    """Two folders of CSV files with their columns in another order and ids in common: the first file's row stays."""
    path = scratch_path(t.spark, "csv-folder")
    named = t.documents.select(F.col("doc_id").cast("string").alias("job_id"), F.col("text").alias("job_description"), "source")
    moved = (F.col("doc_id") + F.when(F.col("doc_id") % 2 == 1, 1000000000).otherwise(0)).cast("string").alias("job_id")
    again = t.documents.select(F.lit("again").alias("source"), F.col("text").alias("job_description"), moved)
    files.write_csv(named, f"{path}/a")
    files.write_csv(again, f"{path}/b")
    found = files.read_csv(t.spark, [f"{path}/a", f"{path}/b"], sequence="_seq")
    return rows.keep_first(found, ["job_id"], "_seq").select("job_id", "job_description", "source")


_LOG_COLUMNS = ["jobs_collected", "jobs_validated", "jobs_enriched", "jobs_vectorized", "jobs_inserted", "jobs_updated", "jobs_failed"]


@query("""
WITH docs AS (SELECT count(*) AS n FROM documents),
stages AS (SELECT unnest(['collect', 'validate', 'enrich', 'vectorize', 'export']) AS stage,
    unnest(['jobs_collected', 'jobs_validated', 'jobs_enriched', 'jobs_vectorized', 'jobs_inserted']) AS counter)
SELECT stage, 'success' AS status, """ + ", ".join(f"CASE counter WHEN '{c}' THEN n ELSE 0 END AS {c}" for c in _LOG_COLUMNS) + """,
    CAST(1 AS BIGINT) AS total_runs, CAST(0 AS BIGINT) AS failed_runs, CAST(0 AS DOUBLE) AS failure_rate FROM stages, docs""")
def batch_log(t: Tables) -> DataFrame:
    """The log that a day over the documents writes, folded to one row a stage, beside its failure rates."""
    name = lambda c: F.struct(c.alias("display_name"))
    key = F.col("doc_id").cast("string")
    hit = F.struct(
        key.alias("id"), F.lit("Document in prose").alias("title"), F.lit("2026-01-05T00:00:00Z").alias("created"),
        F.col("text").alias("description"), F.concat(F.lit("http://docs.example/"), key).alias("redirect_url"),
        name(F.col("source")).alias("company"), name(F.col("lang")).alias("location"), *[F.lit(None).cast("double").alias(f"salary_{x}") for x in ("min", "max")],
        F.lit(None).cast("string").alias("salary_currency"),
    )
    page = (F.col("doc_id") + 1).cast("int").alias("page")
    landed = t.documents.select(F.col("source").alias("query"), F.col("lang").alias("location"), page, F.array(hit).alias("results"))
    day = daily.Day(t.spark, scratch_path(t.spark, "daily-texts"), datetime(2026, 1, 8, 0, 30), limit=10**9)
    daily.run_day(day, landed)
    log = runs.current_runs(day.runs_log())
    rates = reports.failure_rate(log, F.current_date(), folded=True)
    return log.select("stage", "status", *_LOG_COLUMNS).join(rates, "stage")


@query("""
SELECT 'Clerk of ' || o_orderpriority AS job_title, 'Customer ' || o_custkey AS company_name,
    CASE o_orderpriority WHEN '1-URGENT' THEN '1-Urgent' WHEN '2-HIGH' THEN '2-High' WHEN '3-MEDIUM' THEN '3-Medium'
        WHEN '4-NOT SPECIFIED' THEN '4-Not Specified' ELSE '5-Low' END AS location,
    CAST(o_orderdate AS DATE) AS posted_date, CAST(trunc(o_totalprice) AS BIGINT) AS salary_min,
    CAST(trunc(o_totalprice * 1.25) AS BIGINT) AS salary_max, true AS has_salary, false AS has_skills,
    'http://jobs.example/' || o_orderkey AS url, o_orderstatus AS search_query, 1.0::DOUBLE AS data_quality_score
FROM orders""")
def daily_batch(t: Tables) -> DataFrame:
    """All five stages over the landed pages, run twice: the second day only updates."""
    root = scratch_path(t.spark, "daily")
    landed = written(landed_pages(t), "landed")
    first = daily.Day(t.spark, root, datetime(2026, 1, 8, 0, 30), limit=10**9)
    daily.run_day(first, landed)
    jobs = daily.run_day(replace(first, now=datetime(2026, 1, 9, 0, 30), batch_id="second"), landed)
    return jobs.select(
        "job_title", "company_name", "location", "posted_date", "salary_min", "salary_max", "has_salary", "has_skills",
        "url", "search_query", "data_quality_score",
    )


@query("""
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS posted_month, count(*) AS jobs FROM orders
WHERE o_orderdate >= TIMESTAMP '2000-02-10' GROUP BY ALL""")
def month_partitions(t: Tables) -> DataFrame:
    """Written by month, read back from a date on: earlier months are never opened."""
    path = scratch_path(t.spark, "jobs-by-month")
    jobs = t.orders.select(F.col("o_orderkey").cast("string").alias("job_id"), F.to_date("o_orderdate").alias("posted_date"))
    files.write_jobs(jobs, path)
    recent = files.read_jobs(t.spark, path, since="2000-02-10")
    return tables.with_month(recent).groupBy("posted_month").agg(F.count(F.lit(1)).alias("jobs"))


@query("""
WITH day_jobs AS (SELECT CAST(ts AS DATE) AS batch_date, count(*) AS jobs_created FROM events GROUP BY ALL),
runs AS (SELECT CAST(l_shipdate + INTERVAL 8400 DAY AS DATE) AS batch_date, l_orderkey, l_linestatus FROM lineitem),
day_runs AS (SELECT batch_date, count(DISTINCT l_orderkey) AS batches, count(*) FILTER (WHERE l_linestatus = 'O') AS successful,
    count(*) FILTER (WHERE l_linestatus = 'F') AS failed FROM runs GROUP BY ALL)
SELECT * FROM day_jobs JOIN day_runs USING (batch_date)""")
def jobs_and_runs_by_day(t: Tables) -> DataFrame:
    runs = t.lineitem.select(
        F.date_add(F.to_date("l_shipdate"), 8400).alias("batch_date"),
        F.col("l_orderkey").alias("batch_id"),
        F.when(F.col("l_linestatus") == "O", "success").when(F.col("l_linestatus") == "F", "failed").alias("status"),
    )
    return reports.jobs_and_runs_by_day(t.events.select("ts"), runs, "ts")
