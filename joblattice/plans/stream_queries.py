"""Queries that run the streams over the supplied events and read what they wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from joblattice.plans.catalog import Tables, query
from joblattice.plans.row_queries import landed_pages
from joblattice.session import scratch_path
from joblattice.streaming import flows
from joblattice.streaming.changes import ChangeLog


def _drained(t: Tables, stream: DataFrame, label: str, mode: str = "append") -> DataFrame:
    out, checkpoint = scratch_path(t.spark, label), scratch_path(t.spark, f"{label}-progress")
    schema = stream.schema
    flows.drain(stream, out, checkpoint, mode)
    return flows.read_drained(t.spark, out, schema)


def _events(t: Tables) -> DataFrame:
    stored = t.events.schema
    # A path with a pattern may name a single file as well as a folder.
    stream = flows.read_parquet_stream(t.spark, t.path("events") + "*", stored)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


@query("SELECT event_id, user_id, event_type FROM events")
def stream_dedup(t: Tables) -> DataFrame:
    """Events delivered twice, once each after the stream."""
    twice = _events(t).withColumn("delivery", F.explode(F.array(F.lit(1), F.lit(2)))).select("event_id", "user_id", "event_type", "ts")
    return _drained(t, flows.dedup_stream(twice, ["event_id"], "ts"), "dedup").select("event_id", "user_id", "event_type")


@query("SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS rows FROM events GROUP BY ALL")
def stream_daily(t: Tables) -> DataFrame:
    counts = flows.daily_count_stream(_events(t).select("ts", "event_type"), "ts", ["event_type"])
    return flows.latest_update(_drained(t, counts, "daily", "update"), ["day", "event_type"])


@query("""
WITH changes AS (SELECT user_id AS c_custkey, arg_min(event_type, event_id) AS segment, arg_max(value, event_id) AS balance FROM events GROUP BY user_id)
SELECT coalesce(c.c_custkey, u.c_custkey) AS c_custkey, coalesce(c_mktsegment, segment) AS segment, coalesce(balance, c_acctbal) AS balance
FROM customer c FULL JOIN changes u ON c.c_custkey = u.c_custkey""")
def stream_upsert(t: Tables) -> DataFrame:
    """Customers with the streamed events applied: the balance follows the last event, the segment stays."""
    changes = _events(t).select(
        F.col("user_id").alias("c_custkey"), F.col("event_type").alias("segment"), F.col("value").alias("balance"), F.col("event_id").alias("_seq")
    )
    base = t.customer.select("c_custkey", F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"))
    return flows.current_table(base, _drained(t, changes, "changes"), "c_custkey", "_seq", ["balance"])


_LANDINGS = 5


@query(f"""
WITH placed AS (SELECT *, ({_LANDINGS - 1} - event_id % {_LANDINGS}) * 1000000000000 + event_id AS place FROM events),
changes AS (SELECT user_id AS c_custkey, arg_min(event_type, place) AS segment, arg_max(value, place) AS balance FROM placed GROUP BY user_id)
SELECT coalesce(c.c_custkey, u.c_custkey) AS c_custkey, coalesce(c_mktsegment, segment) AS segment, coalesce(balance, c_acctbal) AS balance
FROM customer c FULL JOIN changes u ON c.c_custkey = u.c_custkey""")
def stream_upsert_folded(t: Tables) -> DataFrame:
    """Events that land in several parts, the later event of a pair often first, in a log that folds itself in three slices."""
    events = t.events.select(
        F.col("user_id").alias("c_custkey"), F.col("event_type").alias("segment"), F.col("value").alias("balance"), F.col("event_id").alias("_seq")
    )
    landed = scratch_path(t.spark, "landed-events")
    log = ChangeLog(t.spark, scratch_path(t.spark, "changes"), events.schema, "c_custkey", "_seq", ["balance"], slices=3)
    for part in reversed(range(_LANDINGS)):
        events.filter(F.col("_seq") % _LANDINGS == part).write.mode("append").parquet(landed)
        log.drain(flows.read_parquet_stream(t.spark, landed, events.schema))
    return log.current_table(t.customer.select("c_custkey", F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance")))


@query("""
SELECT 'http://jobs.example/' || o_orderkey AS url, 'Customer ' || o_custkey AS company_name, o_orderstatus AS search_query,
    CAST(o_orderdate AS DATE) AS posted_date, CAST(trunc(o_totalprice) AS BIGINT) AS salary_min FROM orders""")
def stream_collect(t: Tables) -> DataFrame:
    """Pages landed as JSON files, streamed into valid, clean listings."""
    landed = scratch_path(t.spark, "landed")
    landed_pages(t).write.json(landed)
    raw = flows.raw_job_stream(flows.read_page_stream(t.spark, landed))
    clean = flows.clean_job_stream(raw, F.lit("2001-08-02").cast("date"))
    return _drained(t, clean, "clean").select("url", "company_name", "search_query", "posted_date", "salary_min")
