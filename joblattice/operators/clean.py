"""The cleaning chain from raw to clean listings, and its statistics."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from joblattice.constants import UNKNOWN_COMPANY, UNKNOWN_LOCATION
from joblattice.functions.skills import extract_skills, vocab_skills
from joblattice.functions.text import clean_text, normalize_job_title, standardize_location
from joblattice.functions.values import days_since, parse_posted_date, parse_salary
from joblattice.operators.rows import align_schema, keep_first
from joblattice.schemas import CLEAN_JOBS


def clean_jobs(
    raw: DataFrame,
    as_of: Column,
    order: str = "_seq",
    keywords: Iterable[str] | None = None,
    date_formats: tuple[str, ...] = (),
    thousands: str = " ",
) -> DataFrame:
    """First row per job, cleaned and enriched, in the 16-column layout.

    Duplicates go before untitled rows do: a job whose first copy has no title is lost.
    """
    return clean_rows(keep_first(raw, ["job_id"], order), as_of, keywords, date_formats, thousands)


def clean_rows(
    rows: DataFrame,
    as_of: Column,
    keywords: Iterable[str] | None = None,
    date_formats: tuple[str, ...] = (),
    thousands: str = " ",
    extra: tuple[str, ...] = (),
) -> DataFrame:
    """The cleaning of each row by itself, for streams too; rows without a title are dropped.

    Columns named in ``extra`` pass through behind the 16.
    """
    titled = rows.withColumn("job_title", clean_text(F.col("job_title"))).filter(F.col("job_title").isNotNull())
    texts = titled.withColumns(
        {
            "company_name": F.coalesce(clean_text(F.col("company_name")), F.lit(UNKNOWN_COMPANY)),
            "location": F.coalesce(standardize_location(F.col("location")), F.lit(UNKNOWN_LOCATION)),
            "job_description": clean_text(F.col("job_description")),
            "posted_date": parse_posted_date(F.col("posted_date"), date_formats),
            "_salary": parse_salary(F.col("salary_range"), thousands),
        }
    )
    enriched = texts.withColumn("skills_required", extract_skills(F.col("job_description"), keywords)).withColumns(
        {
            "salary_min": F.col("_salary.salary_min"),
            "salary_max": F.col("_salary.salary_max"),
            "days_since_posted": days_since(F.col("posted_date"), as_of),
            "has_salary": F.col("salary_range").isNotNull(),
            "has_skills": F.col("skills_required").isNotNull(),
        }
    )
    passed = [f for f in rows.schema.fields if f.name in extra]
    return align_schema(enriched, T.StructType(CLEAN_JOBS.fields + passed))


def cleaning_stats(clean: DataFrame) -> DataFrame:
    """One row of totals, shares and distinct counts over a clean table."""
    share = lambda flag: F.round(100.0 * F.avg(F.col(flag).cast("int")), 1)
    return clean.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if("has_salary").alias("with_salary"),
        share("has_salary").alias("with_salary_pct"),
        F.count_if("has_skills").alias("with_skills"),
        share("has_skills").alias("with_skills_pct"),
        F.count_distinct("company_name").alias("companies"),
        F.count_distinct("location").alias("locations"),
        F.count_distinct("search_query").alias("search_queries"),
    )


def cleaning_step_counts(raw: DataFrame, order: str = "_seq", key: str = "job_id", title: str = "job_title") -> DataFrame:
    """One row: rows read, duplicates removed, untitled rows removed, rows left."""
    firsts = raw.select(key, order, clean_text(F.col(title)).isNotNull().alias("titled"))
    per_key = firsts.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(order, "titled")).alias("first"))
    totals = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("initial_rows"),
        F.count(F.lit(1)).alias("kept"),
        F.count_if(F.col("first.titled")).alias("final_rows"),
    )
    return totals.select(
        "initial_rows",
        (F.col("initial_rows") - F.col("kept")).alias("duplicates_removed"),
        (F.col("kept") - F.col("final_rows")).alias("no_title_removed"),
        "final_rows",
    )


def add_normalized_title(df: DataFrame, source: str = "job_title", target: str = "job_title_normalized") -> DataFrame:
    return df.withColumn(target, normalize_job_title(F.col(source).cast("string")))


def add_skills(
    df: DataFrame,
    source: str = "job_description",
    target: str = "skills_required",
    vocab: Iterable[str] | None = None,
    aliases: dict[str, str] | None = None,
) -> DataFrame:
    return df.withColumn(target, vocab_skills(F.col(source).cast("string"), vocab, aliases))
