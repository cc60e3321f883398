from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from joblattice.operators import clean, dictionary, rows, tables, validate
from joblattice.schemas import JOBS, RAW_JOBS


def keyed(spark, pairs):
    return spark.createDataFrame([(k, i, v) for i, (k, v) in enumerate(pairs)], "job_id string, _seq long, v string")


def test_align_schema(spark):
    df = spark.createDataFrame([("a", 1)], "job_id string, extra int")
    out = rows.align_schema(df, RAW_JOBS)
    assert out.schema == RAW_JOBS and out.first()["job_id"] == "a" and out.first()["url"] is None


def test_keep_first_and_last_with_null_keys(spark):
    df = keyed(spark, [("a", "1"), (None, "2"), ("a", "3"), (None, "4")])
    assert sorted(r["v"] for r in rows.keep_first(df, ["job_id"], "_seq").collect()) == ["1", "2"]
    assert sorted(r["v"] for r in rows.keep_last(df, ["job_id"], "_seq").collect()) == ["3", "4"]


def test_first_per_key_beyond_the_self_limiting_size(spark):
    df = spark.range(6000).select(F.when(F.col("id") < 4000, "hot").otherwise("cold").alias("k"), "id")
    out = rows.first_per_key(df, ["k"], [F.asc("id")], 1500)
    assert out.groupBy("k").agg(F.count("*"), F.max("id")).orderBy("k").collect() == [("cold", 1500, 5499), ("hot", 1500, 1499)]


def test_hot_keys_are_cut_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("k"), "id")
    plan = rows.first_per_key(df, ["k"], [F.asc("id")])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")


@pytest.fixture(params=["few rows", "many rows"])
def either_size(request, monkeypatch):
    """Run a test with the size check passed and failed; both ways must give the same."""
    if request.param == "many rows":
        monkeypatch.setattr(rows, "is_small", lambda *_: False)


@pytest.mark.parametrize("unique", [False, True])
def test_append_keeps_old_rows_and_repeats_nothing(spark, either_size, unique):
    old = keyed(spark, [("a", "old a"), ("b", "old b"), (None, "old none")])
    new = keyed(spark, [("c", "new c"), ("a", "new a"), ("c", "again c"), (None, "new none")])
    once = rows.append_dedup(old, new, existing_unique=unique)
    assert sorted(r["v"] for r in once.collect()) == ["new c", "old a", "old b", "old none"]
    assert sorted(r["v"] for r in rows.append_dedup(once, new).collect()) == ["new c", "old a", "old b", "old none"]
    assert rows.append_stats(old, new).first().asDict() == {"duplicates_removed": 3, "new_entries": 1, "total": 4}


def test_or_sample(spark):
    empty, sample = spark.createDataFrame([], "a int"), spark.createDataFrame([(1,)], "a int")
    assert rows.or_sample(empty, sample).count() == 1 and rows.or_sample(sample, empty).count() == 1


RAW = "job_id string, job_title string, url string, location string, posted_date string, salary_min string, salary_max string"


@pytest.fixture(scope="module")
def mixed(spark):
    good = ("Data Engineer", "http://x", "Paris", "2026-01-01", "1", "2")
    return spark.createDataFrame(
        [
            ("ok", *good),
            ("twin", *good),
            ("twin", None, "http://x", "Paris", None, None, None),
            ("short", "Engineer", "ftp://x", "Paris", "2026-01-01", None, "2"),
            ("many", "  ", " ", None, "soon", "9", "2"),
            ("words", "Data Engineer", "http://x", "Paris", None, "low", "2"),
            (None, *good),
            (None, "x", *good[1:]),
        ],
        RAW,
    )


def test_rules_add_up(mixed):
    out = validate.rule_counts(mixed).first().asDict()
    assert out == {
        "missing_title": 2, "invalid_title_length": 2, "missing_url": 1, "missing_location": 1, "invalid_date": 1,
        "invalid_salary": 2, "valid_count": 3, "total": 8,
    }
    checked = validate.with_failed_rules(mixed)
    many = checked.filter("job_id = 'many'").first()[validate.FAILED]
    assert many == ["missing_title", "missing_url", "missing_location", "invalid_date", "invalid_salary"]
    assert validate.reject_reasons(checked).first()["rows"] == 2
    assert validate.validation_report(mixed).first()["pass_rate"] == 37.5
    assert validate.rule_counts(mixed, url_format=True).first()["invalid_url"] == 1


def test_title_length_bounds(spark):
    df = spark.createDataFrame([("x" * n,) for n in (9, 10, 500, 501)], "job_title string")
    bad = validate.with_failed_rules(df).filter(F.array_contains(validate.FAILED, "invalid_title_length"))
    assert sorted(len(r["job_title"]) for r in bad.collect()) == [9, 501]


def test_failing_twins_of_valid_rows_stay(mixed, either_size):
    kept = validate.keep_by_valid_key(validate.with_failed_rules(mixed))
    assert sorted(str(r["job_id"]) for r in kept.collect()) == ["None", "None", "ok", "twin", "twin"]


def test_not_a_number_passes_as_missing_does(spark):
    df = spark.createDataFrame([("nan", "2"), ("3", "nan"), ("3", "2")], "salary_min string, salary_max string")
    assert validate.rule_counts(df).first()["invalid_salary"] == 1


def test_a_third_of_all_rows_under_one_key(spark, either_size):
    n = 3000
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 500).cast("string")))
    df = spark.range(n).select(key.alias("job_id"), F.col("id").alias("_seq"))
    names = ["hot" if i % 3 == 0 else f"k{i % 500}" for i in range(n)]
    first = {}
    for i, name in enumerate(names):
        first.setdefault(name, i)
    kept = rows.keep_first(df.repartition(7), ["job_id"], "_seq")
    assert {r["job_id"]: r["_seq"] for r in kept.collect()} == first
    old, new = df.filter("_seq < 1000"), df.filter("_seq >= 1000")
    assert {r["job_id"]: r["_seq"] for r in rows.append_dedup(old, new).collect()} == first
    titles = F.when(F.col("_seq") == 0, "Data Engineer")
    checked = validate.with_failed_rules(df.withColumns({"job_title": titles, "url": F.lit("u"), "location": F.lit("p")}))
    assert validate.keep_by_valid_key(checked).count() == names.count("hot")


def test_repair(spark):
    df = spark.createDataFrame([("soon", " ", "9", "2"), (None, "Paris", "low", "3")], "posted_date string, location string, salary_min string, salary_max string")
    out = validate.repair(df, F.lit("2026-02-03").cast("date")).collect()
    assert [tuple(r) for r in out] == [("2026-02-03", "Unknown", 2.0, 9.0), (None, "Paris", None, 3.0)]


def raw_jobs(spark, *records):
    columns = [f.name for f in RAW_JOBS.fields]
    data = [tuple({"job_id": str(i), "job_title": "Data Engineer", **r}.get(c) for c in columns) + (i,) for i, r in enumerate(records)]
    return spark.createDataFrame(data, ", ".join(f"{c} string" for c in columns) + ", _seq long")


def test_clean_jobs(spark):
    raw = raw_jobs(
        spark,
        {"job_id": "a", "job_title": " <b>Lead</b>  ML ", "company_name": " ", "location": "paris 1er (75)", "posted_date": "2026-01-01T09:00:00Z",
         "job_description": "<p>Python\nand SQL</p>", "salary_range": "45 000 - 60 000 EUR", "url": "u", "source": "s", "search_query": "q"},
        {"job_id": "a", "job_title": "second copy"},
        {"job_id": "b", "job_title": "<i></i>"},
        {"job_id": "b", "job_title": "titled second copy is lost with the first"},
        {"job_id": "c", "salary_range": "Competitive", "posted_date": "junk"},
    )
    out = {r["job_id"]: r.asDict() for r in clean.clean_jobs(raw, F.lit("2026-01-08").cast("date")).collect()}
    assert sorted(out) == ["a", "c"]
    a, c = out["a"], out["c"]
    assert (a["job_title"], a["company_name"], a["location"], a["job_description"]) == ("Lead ML", "Unknown Company", "Paris", "Python and SQL")
    assert (a["skills_required"], a["salary_min"], a["salary_max"], a["days_since_posted"]) == ("Python, SQL", 45000, 60000, 7)
    assert (c["location"], c["has_salary"], c["salary_min"], c["posted_date"], c["has_skills"]) == ("Unknown Location", True, None, None, False)
    stats = clean.cleaning_stats(clean.clean_jobs(raw, F.lit("2026-01-08").cast("date"))).first().asDict()
    assert stats == {"rows": 2, "with_salary": 2, "with_salary_pct": 100.0, "with_skills": 1, "with_skills_pct": 50.0, "companies": 1, "locations": 2, "search_queries": 1}
    steps = clean.cleaning_step_counts(raw).first().asDict()
    assert steps == {"initial_rows": 5, "duplicates_removed": 2, "no_title_removed": 1, "final_rows": 2}


def test_dictionary_joins(spark):
    docs = spark.createDataFrame([(1, "py and SQL boxes"), (2, "none at all"), (3, None)], "id int, text string")
    forms = spark.createDataFrame([("py", "python"), ("sql", "sql"), ("at all", "phrase")], "form string, skill string")
    found = {r["id"]: r["skills"] for r in dictionary.skills_by_join(docs, "id", "text", forms).collect()}
    assert found == {1: ["python", "sql"], 2: [], 3: []}
    found = {r["id"]: r["skills"] for r in dictionary.skills_by_join(docs, "id", "text", forms, longest=2).collect()}
    assert found == {1: ["python", "sql"], 2: ["phrase"], 3: []}
    lemmas = spark.createDataFrame([("boxes", "box"), ("all", "a")], "form string, lemma string")
    out = {r["id"]: r["tokens"] for r in dictionary.lemmatized_tokens(docs, "id", "text", lemmas).collect()}
    assert out == {1: ["py", "and", "sql", "box"], 2: ["none", "at"], 3: []}


@pytest.mark.parametrize("sizes", [[True, True], [False, True], [False, False]], ids=["one list", "occurring forms", "own entries"])
def test_dictionary_of_any_size(spark, monkeypatch, sizes):
    """Against plain look-ups: repeated forms, null keys, repeated rows, rows without a known word, an empty text."""
    rng = random.Random(9)
    words = [a + b for a in "abcdefgh" for b in "klmnop"]
    table = [(w, f"{w[0]}{i}") for w in words[::3] for i in range(1 + (w[1] == "k"))] + [("ak", None), (None, "x"), ("zz", "never")]
    rows = [(None if i == 5 else i % 30, " ".join(rng.choices(words, k=i % 17))) for i in range(40)]
    docs = spark.createDataFrame([*rows, (50, None)], "id int, text string")
    answers = iter(sizes)
    monkeypatch.setattr(dictionary, "is_small", lambda _: next(answers))
    lemmas = spark.createDataFrame(table, "form string, lemma string")
    out = dictionary.lemmatized_tokens(docs, "id", "text", lemmas).collect()
    known = {}
    for form, lemma in table:
        known.setdefault(form, []).append(lemma or form)
    plain = [(k, [t for w in (x or "").split() for t in sorted(known.get(w, [w]))]) for k, x in [*rows, (50, None)]]
    assert sorted(map(repr, ((r["id"], r["tokens"]) for r in out))) == sorted(map(repr, plain))
    answers = iter(sizes)
    found = dictionary.skills_by_join(docs, "id", "text", lemmas.withColumnRenamed("lemma", "skill")).collect()
    skills = [(k, sorted({s for f, s in table if s and f in (x or "").split()})) for k, x in [*rows, (50, None)]]
    assert sorted(map(repr, ((r["id"], r["skills"]) for r in found))) == sorted(map(repr, skills))


def test_dictionary_moves_no_words(spark):
    docs = spark.range(0, 100, 1, 8).select("id", F.lit("py and sql").alias("text"))
    lemmas = spark.createDataFrame([("py", "python")], "form string, lemma string")
    plan = dictionary.lemmatized_tokens(docs, "id", "text", lemmas)._jdf.queryExecution().optimizedPlan()
    assert "Generate" not in plan.toString() and "Join" not in plan.toString()


# --- upsert -----------------------------------------------------------------------------------------


def applied_in_order(target, batch):
    """Plain re-telling of the upsert, row by row."""
    out, inserted, updated = {k: (a, b) for k, a, b in target}, 0, 0
    for k, a, b in batch:
        if k in out:
            out[k], updated = (out[k][0], b), updated + 1
        else:
            out[k], inserted = (a, b), inserted + 1
    return out, inserted, updated


@pytest.mark.parametrize("path", ["small", "large"])
def test_upsert_like_row_by_row(spark, monkeypatch, path):
    rng = random.Random(4)
    target = [(f"k{i}", f"first {i}", f"value {i}") for i in range(40)]
    batch = [("k1" if i % 3 == 0 else f"k{rng.randint(0, 80)}", f"new first {i}", f"new value {i}") for i in range(90)]
    expected, inserted, updated = applied_in_order(target, batch)
    stored = spark.createDataFrame(target, "job_id string, a string, b string")
    changes = spark.createDataFrame([(*r, i) for i, r in enumerate(batch)] + [(None, "x", "y", 999)], "job_id string, a string, b string, _seq int")
    if path == "large":
        monkeypatch.setattr(tables, "is_small", lambda *_: False)
    merged = tables.upsert(stored, changes.repartition(3), order="_seq", update_columns=["b"])
    assert {r["job_id"]: (r["a"], r["b"]) for r in merged.collect()} == expected
    assert merged.count() == len(expected)
    again = tables.upsert(merged, changes, order="_seq", update_columns=["b"])
    assert sorted(again.collect()) == sorted(merged.collect())
    assert tables.upsert_counts(stored, changes).first().asDict() == {"inserted": inserted, "updated": updated, "failed": 1}


def test_small_upsert_leaves_the_target_in_place(spark):
    target = spark.range(1000).select(F.col("id").cast("string").alias("job_id"), F.lit("x").alias("b"))
    batch = spark.createDataFrame([("5", "y")], "job_id string, b string")
    plan = tables.upsert(target, batch, update_columns=["b"])._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_job_rows(spark):
    now = F.lit("2026-01-08 00:30:00").cast("timestamp")
    rows_in = spark.createDataFrame([("a", "t", 3)], "job_id string, job_title string, days_since_posted int")
    out = tables.as_job_rows(rows_in, now)
    assert out.dtypes == [(f.name, f.dataType.simpleString()) for f in JOBS.fields]
    row = out.first()
    assert (row["source"], row["data_quality_score"], row["days_since_posted"]) == ("adzuna", 1.0, None)


def test_archive_rollback_delete(spark):
    jobs = spark.createDataFrame([("a", "2024-01-07"), ("b", "2025-01-08"), ("c", None)], "job_id string, d string").withColumn("posted_date", F.col("d").cast("date"))
    kept, old = tables.archive_split(jobs, F.lit("2026-01-08").cast("date"))
    assert sorted(r["job_id"] for r in kept.collect()) == ["b", "c"] and [r["job_id"] for r in old.collect()] == ["a"]
    made = jobs.withColumn("created_at", F.col("d").cast("timestamp"))
    back = tables.rollback(made, F.lit("2025-01-01").cast("timestamp"), made.filter("job_id in ('a', 'b')"))
    assert sorted(r["job_id"] for r in back.collect()) == ["a", "b", "c"]
    gone = spark.createDataFrame([("a",), ("a",)], "job_id string")
    assert sorted(r["job_id"] for r in tables.delete_keys(jobs, gone).collect()) == ["b", "c"]
