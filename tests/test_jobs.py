from __future__ import annotations

import datetime
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from joblattice.operators import reports, rows, runs, tables
from joblattice.plans import daily
from joblattice.schemas import API_PAGE, BATCH_RUNS, HIT, JOBS, RAW_JOBS
from joblattice.sources import files, monthly, pages
from joblattice.sources.snapshots import Snapshots
from joblattice.streaming import changes, flows


def hit(i, title="Senior Data Engineer", description="We use Python and SQL", low=45000.0, place="Paris 1er"):
    return (str(i), title, f"2026-01-0{i % 7 + 1}T00:00:00Z", description, f"http://x/{i}", ("ACME",), (place,), low, 60000.0, None)


@pytest.fixture(scope="module")
def landed(spark):
    rows = [
        ("data", "Paris", 1, [hit(1), hit(2, "short"), hit(1)]),
        ("data", "Paris", 2, []),
        ("data", "Paris", 3, [hit(9)]),
        ("data", "Lyon", 1, [hit(3, "Lead ML Engineer"), hit(4, "Backend Developer x", None, 0.0)]),
        ("data", "Lyon", 2, [hit(5), hit(1)]),
        ("data", "Lyon", 3, None),
        ("data", "Lyon", 4, [hit(8)]),
    ]
    return spark.createDataFrame(rows, API_PAGE)


def test_pages_stop_at_the_first_empty_one(landed):
    kept = pages.before_first_empty(landed).select("location", "page").collect()
    assert sorted(tuple(r) for r in kept) == [("Lyon", 1), ("Lyon", 2), ("Paris", 1)]


def test_collect_limits_each_search_in_page_order(landed):
    out = pages.collect_jobs(landed, 3, locations=["Paris", "Lyon"]).orderBy("_seq").collect()
    assert [r["url"][-1] for r in out] == ["1", "2", "1", "3", "4", "5"]
    assert out[0]["job_id"] == out[2]["job_id"] and len({r["job_id"] for r in out}) == 5
    assert out[0]["salary_range"] == "45 000 - 60 000 EUR" and out[4]["salary_range"] is None
    assert (out[0]["source"], out[0]["search_query"], out[0]["skills_required"]) == ("adzuna", "data", None)


def test_pages_from_json_files(spark, landed, folder):
    landed.write.json(f"{folder}/pages")
    read = pages.read_pages(spark, f"{folder}/pages")
    assert read.schema["results"].dataType.elementType.fieldNames() == HIT.fieldNames()
    assert pages.unify_schema(pages.collect_jobs(read, 50)).count() == 7


def test_csv_round_trip(spark, folder):
    text = 'He said "hi",\nthen é left; a\\b'
    df = spark.createDataFrame([("1", text), ("2", None)], "job_id string, job_description string")
    files.write_csv(df, f"{folder}/raw")
    back = files.with_sequence(files.read_csv(spark, f"{folder}/raw")).orderBy("job_id").collect()
    assert [c for c in back[0].asDict() if c != "_seq"] == RAW_JOBS.fieldNames()
    assert back[0]["job_description"] == text and back[1]["job_description"] is None


def test_monthly_jobs_are_pruned(spark, folder):
    df = spark.createDataFrame([("a", "2026-01-05"), ("b", "2026-02-05"), ("c", None)], "job_id string, d string")
    files.write_jobs(df.withColumn("posted_date", F.col("d").cast("date")), f"{folder}/jobs")
    assert files.read_jobs(spark, f"{folder}/jobs").count() == 3
    recent = files.read_jobs(spark, f"{folder}/jobs", since="2026-01-20")
    assert [r["job_id"] for r in recent.collect()] == ["b"]
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "posted_month" in plan.split("PartitionFilters:")[1].split("PushedFilters")[0]


def test_snapshots(spark, folder):
    table = Snapshots(spark, folder, lambda df, p: df.write.parquet(p), lambda s, p: s.read.parquet(p))
    assert not table.exists()
    with pytest.raises(LookupError):
        table.read()
    now = F.lit("2026-01-08").cast("timestamp")
    assert table.commit(spark.range(3), now) == 1
    assert table.commit(table.read().filter("id > 0"), now) == 2
    assert table.read().count() == 2 and table.read(1).count() == 3 and table.history().count() == 2


def test_five_stages_twice(spark, landed, folder):
    day = daily.Day(spark, folder, datetime.datetime(2026, 1, 8, 0, 30), locations=["Paris", "Lyon"])
    jobs = daily.run_day(day, landed)
    assert jobs.count() == 4
    next_day = daily.Day(spark, folder, datetime.datetime(2026, 1, 9, 0, 30), locations=["Paris", "Lyon"])
    again = daily.run_day(next_day, landed)
    stamps = {(str(r["created_at"])[:10], str(r["updated_at"])[:10]) for r in again.collect()}
    assert stamps == {("2026-01-08", "2026-01-09")}
    log = runs.current_runs(next_day.runs_log())
    assert log.schema.fieldNames() == BATCH_RUNS.fieldNames() and log.count() == 10
    totals = {r["batch_id"]: r for r in reports.batch_health(log).collect()}
    assert totals[day.batch_id]["stages_done"] == 5 and totals[next_day.batch_id]["processed"] == 4
    assert totals[day.batch_id]["failed"] == 1
    last = log.filter((F.col("batch_id") == next_day.batch_id) & (F.col("stage") == "export")).first()
    assert (last["jobs_inserted"], last["jobs_updated"], last["status"]) == (0, 4, "success")
    newest = reports.active_model(next_day.model_versions()).first()
    assert newest["model_version"] == "tfidf_v20260109_003000"


def test_reports_fold_a_written_log(spark):
    """Rows of one run count once, by its last state; at equal times a final state is later than its start."""
    rows = [
        ("b1", "collect", "in_progress", 0, "2026-01-08 00:00:00"), ("b1", "collect", "success", 5, "2026-01-08 00:05:00"),
        ("b1", "export", "in_progress", 0, "2026-01-08 00:06:00"), ("b1", "export", "failed", 0, "2026-01-08 00:06:00"),
        ("b2", "collect", "failed", 0, "2026-01-08 01:00:00"), ("b2", "collect", "success", 7, "2026-01-08 02:00:00"),
    ]
    log = spark.createDataFrame(rows, "batch_id string, stage string, status string, jobs_inserted long, at string").select(
        "batch_id", "stage", "status", "jobs_inserted", F.lit(0).alias("jobs_updated"), F.lit("2026-01-08").cast("date").alias("batch_date"),
        F.col("at").cast("timestamp").alias("updated_at"), F.col("at").cast("timestamp").alias("created_at"),
    )
    today = F.lit("2026-01-09").cast("date")
    assert reports.daily_statistics(log, today).first()[1:] == (3, 2, 1, 12)
    assert {r[0]: r[1:] for r in reports.failure_rate(log, today).collect()} == {"collect": (2, 0, 0.0), "export": (1, 1, 100.0)}
    assert reports.success_rate(log, today).first()[1:] == (3, 2, 66.7)
    folded = runs.last_states(log)
    assert folded.columns == log.columns and reports.success_rate(folded, today, folded=True).first()[1:] == (3, 2, 66.7)
    assert reports.success_rate(log.limit(0), today).count() == 0
    counts = {"jobs_collected": F.lit(3), "jobs_enriched": F.lit(2), "execution_time_seconds": F.lit(60)}
    last = reports.last_run(log.withColumns(counts))
    assert tuple(last.drop("batch_date", "created_at").first()) == ("b2", "collect", "success", 3, 2, 7, 60)
    assert reports.last_run(log.limit(0).withColumns(counts)).count() == 0


def test_failed_stage_is_logged(spark, folder):
    day = daily.Day(spark, folder, datetime.datetime(2026, 1, 8))
    with pytest.raises(Exception):
        daily.enrich(day, spark.createDataFrame([(1,)], "nothing int"))
    row = runs.current_runs(day.runs_log()).first()
    assert row["status"] == "failed" and row["error_message"].startswith("enrich failed")


def test_sample_stands_in_for_an_empty_collection(spark, folder):
    day = daily.Day(spark, folder, datetime.datetime(2026, 1, 8))
    sample = spark.createDataFrame([("s", "Sample Engineer")], "job_id string, job_title string")
    kept = daily.collect(day, spark.createDataFrame([], API_PAGE), sample)
    assert kept.first()["job_id"] == "s" and "_seq" in kept.columns


# --- streams --------------------------------------------------------------------------------------------------


def events(spark, folder, *batches):
    """One file per batch, read one per micro-batch, in order."""
    schema = "key string, ts timestamp, v int"
    for i, rows in enumerate(batches):
        df = spark.createDataFrame([(k, datetime.datetime.fromisoformat(t), v) for k, t, v in rows], schema)
        df.coalesce(1).write.mode("append").parquet(f"{folder}/in/{i}")
    return flows.read_parquet_stream(spark, f"{folder}/in/*", df.schema, files_per_batch=1)


def test_repeats_within_the_delay_are_dropped(spark, folder):
    stream = events(
        spark, folder,
        [("a", "2026-01-01T00:00:00", 1), ("a", "2026-01-01T00:01:00", 2), ("b", "2026-01-01T00:02:00", 3)],
        [("a", "2026-01-01T01:00:00", 4), ("c", "2026-01-01T02:00:00", 5)],
    )
    out = flows.dedup_stream(stream, ["key"], "ts")
    flows.drain(out, f"{folder}/out", f"{folder}/progress")
    assert sorted(r["key"] for r in flows.read_drained(spark, f"{folder}/out", out.schema).collect()) == ["a", "b", "c"]


def test_daily_counts_drop_late_rows(spark, folder):
    stream = events(
        spark, folder,
        [("a", "2026-01-01T10:00:00", 1), ("a", "2026-01-05T00:00:00", 1)],
        [("a", "2026-01-05T10:00:00", 1)],
        [("a", "2026-01-01T11:00:00", 1), ("b", "2026-01-05T11:00:00", 1)],
    )
    out = flows.daily_count_stream(stream, "ts", ["key"])
    flows.drain(out, f"{folder}/out", f"{folder}/progress", "update")
    latest = flows.latest_update(flows.read_drained(spark, f"{folder}/out", out.schema), ["day", "key"])
    assert sorted((str(r["day"]), r["key"], r["rows"]) for r in latest.collect()) == [
        ("2026-01-01", "a", 1), ("2026-01-05", "a", 2), ("2026-01-05", "b", 1),
    ]


def test_cleaned_stream_keeps_valid_rows(spark, landed, folder):
    landed.write.json(f"{folder}/landed")
    raw = flows.raw_job_stream(flows.read_page_stream(spark, f"{folder}/landed"))
    clean = flows.clean_job_stream(raw, F.lit("2026-01-10").cast("date"))
    flows.drain(clean, f"{folder}/out", f"{folder}/progress")
    rows = flows.read_drained(spark, f"{folder}/out", clean.schema).collect()
    assert len(rows) == 8 and {r["location"] for r in rows} == {"Paris"} and all(r["_seq"].page > 0 for r in rows)
    applied = flows.current_table(spark.createDataFrame([], clean.drop("_seq").schema), flows.read_drained(spark, f"{folder}/out", clean.schema))
    assert applied.count() == 6


def test_streamed_changes_applied_to_a_table(spark, landed, folder):
    landed.write.json(f"{folder}/landed")
    raw = flows.raw_job_stream(flows.read_page_stream(spark, f"{folder}/landed"), locations=["Paris", "Lyon"])
    flows.drain(raw, f"{folder}/out", f"{folder}/progress")
    drained = flows.read_drained(spark, f"{folder}/out", raw.schema)
    assert drained.count() == 9
    base = spark.createDataFrame([], drained.drop("epoch", "_seq").schema)
    now_current = flows.current_table(base, drained, update_columns=["job_title"])
    assert now_current.count() == 7
    flows.drain(raw, f"{folder}/out", f"{folder}/progress")
    assert flows.read_drained(spark, f"{folder}/out", raw.schema).count() == 9


def test_later_micro_batches_win(spark, folder):
    """Three micro-batches; the later ones hold smaller sequence numbers."""
    schema = "job_id string, job_title string, _seq bigint"
    for epoch, rows in enumerate([[("a", "old", 30), ("b", "only", 31)], [("a", "newer", 7)], [("a", "newest", 1), ("c", "fresh", 2)]]):
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/out/epoch={epoch}")
    changes = flows.read_drained(spark, f"{folder}/out", spark.createDataFrame([], schema).schema)
    base = spark.createDataFrame([("a", "first"), ("z", "kept")], "job_id string, job_title string")
    now = {r.job_id: r.job_title for r in flows.current_table(base, changes, update_columns=["job_title"]).collect()}
    assert now == {"a": "newest", "b": "only", "c": "fresh", "z": "kept"}


def test_upsert_keeps_the_target_schema(spark, monkeypatch):
    from joblattice.operators import tables

    target = spark.createDataFrame([("a", 1, 2)], "k string, n int, m int")
    batch = spark.createDataFrame([("a", 5, 6), ("b", 7, 8)], "k string, n bigint, m bigint")
    small = tables.upsert(target, batch, "k", None, ["n"])
    monkeypatch.setattr(tables, "is_small", lambda df: False)
    large = tables.upsert(target, batch, "k", None, ["n"])
    assert small.dtypes == large.dtypes == target.dtypes
    assert sorted(small.collect()) == sorted(large.collect()) == [("a", 5, 2), ("b", 7, 8)]


def test_csv_keeps_edge_blanks(spark, folder):
    df = spark.createDataFrame([("x", "  lead and trail  ")], "job_id string, job_title string")
    files.write_csv(df, f"{folder}/csv")
    assert files.read_csv(spark, f"{folder}/csv", df.schema).first().job_title == "  lead and trail  "


def test_many_searches_keep_their_order(spark):
    rows = [(f"q{i}", "Paris", p, [hit(1000 * i + 10 * p + j) for j in range(5)]) for i in range(300) for p in (1, 2)]
    frame = spark.createDataFrame(rows, API_PAGE)
    out = pages.collect_jobs(frame, 7, locations=["Paris"])
    assert out.count() == out.select("_seq").distinct().count() == 300 * 7
    first = [r.url for r in out.orderBy("_seq").limit(7).collect()]
    assert [u.rsplit("/", 1)[-1] for u in first] == [str(x) for x in (10, 11, 12, 13, 14, 20, 21)]


def test_cut_pages(spark):
    rows = [("a", None, p, [hit(100 * p + j) for j in range(3)]) for p in (1, 2, 5000)]
    rows += [("a", None, 2, [hit(900), hit(901)]), ("b", "x", 1, [hit(1)]), ("c", "x", None, [hit(7)] * 4), ("d", "x", 1, None)]
    frame = spark.createDataFrame(rows, API_PAGE)

    def sizes(limit):
        hits = pages.explode_hits(pages.limit_pages(frame, limit))
        return {r["query"]: r["count"] for r in hits.groupBy("query").count().collect()}

    for limit in (0, 1, 3, 4, 7, 8, 9, 11, 50):
        assert sizes(limit) == {q: min(n, limit) for q, n in (("a", 11), ("b", 1), ("c", 4)) if limit}


def test_upsert_refuses_unordered_repeats(spark):
    from joblattice.operators import tables

    target = spark.createDataFrame([("a", 1)], "k string, n int")
    with pytest.raises(ValueError):
        tables.upsert(target, spark.createDataFrame([("b", 1), ("b", 2)], "k string, n int"), "k", None, ["n"])


def test_stored_models_bring_their_settings(spark, folder):
    from joblattice.operators import tfidf
    from joblattice.sources import models

    spec = tfidf.Spec(max_features=None, ngram_range=(1, 1), sublinear_tf=True, stopwords=("the",))
    docs = spark.createDataFrame([(1, "the cat cat sat"), (2, "the dog")], "job_id int, job_description string")
    models.build_and_save(docs, "job_id", "job_description", folder, "v1", spec)
    assert models.load(spark, folder, "v1").spec == spec
    models.update_and_save(docs, docs.limit(0), "job_id", "job_description", folder, "v1", "v2")
    assert models.stored_spec(spark, folder, "v2") == (spec, False)


def _files(folder):
    return {str(p.relative_to(folder)) for p in Path(folder).rglob("*.parquet")}


def test_a_batch_rewrites_only_the_months_it_touches(spark, folder):
    kind = T.StructType.fromDDL("job_id string, job_title string, posted_date date, updated_at timestamp")
    day = datetime.date

    def batch(*rows):
        return spark.createDataFrame([(i, t, d, datetime.datetime(2026, 1, 1)) for i, t, d in rows], kind)

    def write(rows, fail=False):
        columns = ("job_title", "posted_date", "updated_at")
        months = table.touched(rows, "job_id")

        def change(held):
            if fail:
                raise OSError("lost")
            return tables.upsert(held, rows, "job_id", update_columns=columns)

        return months, table.rewrite(months, F.current_timestamp(), change)

    def content(number=None):
        return sorted((r["job_id"], r["job_title"], r["posted_date"]) for r in table.read(number).collect())

    table = monthly.MonthlyTable(spark, folder, kind)
    assert table.read().count() == 0
    first = [("a", "old", day(2025, 1, 5)), ("b", "old", day(2025, 2, 5)), ("c", "old", day(2025, 3, 5)), ("d", "old", day(2025, 3, 6)), ("e", "old", None)]
    write(batch(*first))
    before = _files(f"{folder}/data")

    with pytest.raises(OSError):
        write(batch(("a", "new", day(2025, 1, 7))), fail=True)
    assert content() == sorted(first, key=str)

    months, number = write(batch(("a", "new", day(2025, 1, 7)), ("f", "new", day(2025, 4, 1))))
    assert (sorted(months), number) == ([day(2025, 1, 1), day(2025, 4, 1)], 2)
    added = _files(f"{folder}/data") - before
    assert before <= _files(f"{folder}/data") and {f.split("/")[0] for f in added} == {"posted_month=2025-01-01", "posted_month=2025-04-01"}
    opened = {p for p in table.folders().values()}
    assert len(opened) == 5 and sum("000001-" in p for p in opened) == 3

    months, _ = write(batch(("b", "moved", day(2025, 3, 9)), ("e", "dated", day(2025, 4, 2))))  # two months are left empty
    assert set(months) == {day(2025, 2, 1), day(2025, 3, 1), day(2025, 4, 1), None}
    assert day(2025, 2, 1) not in table.folders() and None not in table.folders()
    assert content() == [
        ("a", "new", day(2025, 1, 7)), ("b", "moved", day(2025, 3, 9)), ("c", "old", day(2025, 3, 5)),
        ("d", "old", day(2025, 3, 6)), ("e", "dated", day(2025, 4, 2)), ("f", "new", day(2025, 4, 1)),
    ]
    assert content(1) == sorted(first, key=str)
    read = table.read(months=[day(2025, 4, 1)])
    assert all("posted_month=2025-04-01" in f for f in read.inputFiles()) and read.count() == 2


def test_second_day_leaves_other_months_alone(spark, folder):
    def landed(ids):
        hits = [(str(i), f"Data engineer {i}", f"2025-{1 + i % 6:02d}-03T00:00:00Z", "text", f"http://x/{i}", ("co",), ("Paris",), None, None, None) for i in ids]
        return spark.createDataFrame([("q", "Paris", 1, hits)], API_PAGE)

    day = daily.Day(spark, folder, datetime.datetime(2026, 1, 8, 0, 30))
    assert daily.run_day(day, landed(range(12))).count() == 12
    before = _files(f"{folder}/jobs/data")
    again = daily.run_day(daily.Day(spark, folder, datetime.datetime(2026, 1, 9, 0, 30)), landed([2, 14]))
    assert again.count() == 13
    added = _files(f"{folder}/jobs/data") - before
    assert before <= _files(f"{folder}/jobs/data") and {f.split("/")[0] for f in added} == {"posted_month=2025-03-01"}
    last = {r["stage"]: r for r in day.runs_log().filter("batch_id <> '" + day.batch_id + "' AND status = 'success'").collect()}
    assert (last["export"]["jobs_inserted"], last["export"]["jobs_updated"]) == (1, 1)


def test_change_log_folds_itself(spark, folder):
    """Against a plain re-telling after every micro-batch: smaller orders later, a hot key, null keys and values, empty and repeated micro-batches."""
    rng = random.Random(3)
    schema = "_seq long, k string, made string, value int"
    base = spark.createDataFrame([("k1", "base", 0), ("k50", "base", 0)], "k string, made string, value int")
    log = changes.ChangeLog(spark, folder, spark.createDataFrame([], schema).schema, "k", "_seq", ["value"], slices=3)
    assert log.newest() is None and log.read().count() == 0
    now = {"k1": ("base", 0), "k50": ("base", 0)}
    for number in range(8):
        keys = ["hot" if rng.random() < 0.4 else rng.choice([None, *(f"k{i}" for i in range(9))]) for _ in range(0 if number == 4 else 25)]
        rows = [(1000 - 30 * number + i, k, rng.choice([None, f"{number}-{i}"]), rng.choice([None, i])) for i, k in enumerate(keys)]
        batch = spark.createDataFrame(rng.sample(rows, len(rows)), schema).repartition(2)
        log.add(batch, number)
        for _, k, made, value in rows:
            if k is not None:
                now[k] = (now[k][0] if k in now else made, value)
        log.add(batch, number)  # given again after a failure
        assert log.newest() == number
        if number in (1, 4, 7):
            assert {r["k"]: (r["made"], r["value"]) for r in log.current_table(base).collect()} == now
    opened = {tuple(f.split(f"{folder}/")[1].split("/")[:2]) for f in log.read().inputFiles()}
    assert opened <= {("fold", f"epoch={n}") for n in (5, 6, 7)} | {("log", f"epoch={n}") for n in (6, 7)}
    assert log.read().count() == len({k for k in now if k != "k50"})


def test_change_log_is_whole_after_a_lost_write(spark, folder, monkeypatch):
    batch = spark.createDataFrame([(1, "a", 1)], "_seq long, k string, value int")
    log = changes.ChangeLog(spark, folder, batch.schema, "k", "_seq", ["value"], slices=2)
    log.add(batch, 0)
    later = batch.withColumn("value", F.lit(2))
    with monkeypatch.context() as broken:
        broken.setattr(log, "_rows_of", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            log.add(later, 1)
    assert [r["value"] for r in log.read().collect()] == [1]
    log.add(later, 1)
    assert [r["value"] for r in log.read().collect()] == [2]


@pytest.mark.parametrize("keys, repeated", [([1, 2, None], False), ([1, 2, 1], True), ([None, 2, None], True), ([], False)])
def test_has_repeats(spark, keys, repeated):
    assert rows.has_repeats(spark.createDataFrame([(k,) for k in keys], "k long").repartition(3), ["k"]) is repeated


def test_first_batch_meets_no_empty_table(spark, folder):
    batch = spark.createDataFrame([("a", "x"), ("b", "y")], "job_id string, job_title string")
    held = monthly.MonthlyTable(spark, f"{folder}/jobs", JOBS).read()
    plan = held.select("job_id", "job_title").join(batch.hint("merge"), "job_id", "full_outer")._jdf.queryExecution().executedPlan().toString()
    assert held.count() == 0 and "Join" not in plan and "Exchange" not in plan


def test_unrepeated_listings_are_shuffled_for_no_stage(spark, folder, monkeypatch):
    """Repeats in the landed pages and in rows of another origin still leave the first row of a listing."""
    shuffled = []
    first = rows.first_per_key  # keep_first finds it by name
    monkeypatch.setattr(rows, "first_per_key", lambda *a, **k: shuffled.append(1) or first(*a, **k))
    landed = lambda n: spark.createDataFrame([("q", "paris", i + 1, [hit(i % n)]) for i in range(6)], API_PAGE)
    for n, root in ((6, "once"), (3, "again")):
        day = daily.Day(spark, f"{folder}/{root}", datetime.datetime(2026, 1, 8))
        raw = daily.collect(day, landed(n))
        assert raw.count() == n and bool(shuffled) is (n == 3)
        assert daily.enrich(day, raw).count() == n
        assert daily.enrich(day, raw.unionByName(raw)).count() == n and shuffled
        shuffled.clear()
