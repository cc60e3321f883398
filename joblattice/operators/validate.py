"""Row validation: named rules, counters, reject tables, repair."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from joblattice.functions.text import strip
from joblattice.functions.values import parse_timestamp
from joblattice.operators.rows import only_in

FAILED = "failed_rules"


@dataclass(frozen=True)
class Fields:
    """Which columns hold the checked values; a column the table lacks is treated as all null."""

    title: str = "job_title"
    url: str = "url"
    location: str = "location"
    posted: str = "posted_date"
    salary_min: str = "salary_min"
    salary_max: str = "salary_max"
    key: str = "job_id"
    title_low: int = 10
    title_high: int = 500
    date_formats: tuple[str, ...] = ()


def _value(df: DataFrame, name: str) -> Column:
    return F.col(name).cast("string") if name in df.columns else F.lit(None).cast("string")


def _missing(c: Column) -> Column:
    return c.isNull() | (strip(c) == "")


def rules(df: DataFrame, fields: Fields = Fields(), url_format: bool = False) -> dict[str, Column]:
    """Rule name to a boolean column that is true where the rule fails."""
    title, url, location = (_value(df, n) for n in (fields.title, fields.url, fields.location))
    posted, low, high = (_value(df, n) for n in (fields.posted, fields.salary_min, fields.salary_max))
    low_n, high_n = low.try_cast("double"), high.try_cast("double")
    checks = {
        "missing_title": _missing(title),
        "invalid_title_length": ~_missing(title) & ~F.length(title).between(fields.title_low, fields.title_high),
        "missing_url": _missing(url),
        "missing_location": _missing(location),
        "invalid_date": posted.isNotNull() & parse_timestamp(posted, fields.date_formats).isNull(),
        "invalid_salary": low.isNotNull()
        & high.isNotNull()
        & (low_n.isNull() | high_n.isNull() | (~F.isnan(low_n) & ~F.isnan(high_n) & (low_n > high_n))),
    }
    if url_format:
        checks["invalid_url"] = ~_missing(url) & ~F.rlike(url, F.lit("^https?://"))
    return {name: F.coalesce(check, F.lit(False)) for name, check in checks.items()}


def with_failed_rules(df: DataFrame, fields: Fields = Fields(), url_format: bool = False) -> DataFrame:
    """Adds the array of names of the rules the row fails."""
    checks = rules(df, fields, url_format)
    names = [F.when(check, F.lit(name)) for name, check in checks.items()]
    return df.withColumn(FAILED, F.array_compact(F.array(*names)))


def valid_rows(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size(FAILED) == 0).drop(FAILED)


def rejected_rows(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size(FAILED) > 0)


def keep_by_valid_key(checked: DataFrame, key: str = "job_id") -> DataFrame:
    """Rows whose key belongs to some valid row, so a failing twin of a valid row stays.

    Valid rows pass straight through; only the failing ones are looked up.
    """
    valid, failed = valid_rows(checked), rejected_rows(checked).drop(FAILED)
    return valid.unionByName(only_in(failed, valid, key))


def rule_counts(df: DataFrame, fields: Fields = Fields(), url_format: bool = False) -> DataFrame:
    """One row: a count per rule, ``valid_count``, ``total``; a single pass."""
    checks = rules(df, fields, url_format)
    flagged = df.select(*[check.alias(name) for name, check in checks.items()])
    any_failed = F.lit(False)
    for name in checks:
        any_failed = any_failed | F.col(name)
    return flagged.agg(
        *[F.count_if(F.col(name)).alias(name) for name in checks],
        F.count_if(~any_failed).alias("valid_count"),
        F.count(F.lit(1)).alias("total"),
    )


def validation_report(df: DataFrame, fields: Fields = Fields(), url_format: bool = False) -> DataFrame:
    """``rule_counts`` with ``failed_count`` and ``pass_rate`` in percent."""
    counts = rule_counts(df, fields, url_format)
    failed = F.col("total") - F.col("valid_count")
    rate = F.when(F.col("total") > 0, F.round(100.0 * F.col("valid_count") / F.col("total"), 1))
    return counts.withColumns({"failed_count": failed, "pass_rate": rate})


def reject_reasons(checked: DataFrame) -> DataFrame:
    """Failed rows per rule, most frequent first."""
    reasons = rejected_rows(checked).select(F.explode(FAILED).alias("rule"))
    return reasons.groupBy("rule").agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), "rule")


def repair(df: DataFrame, as_of: Column, fields: Fields = Fields()) -> DataFrame:
    """Mend instead of reject: bad date to ``as_of``, crossed salaries swapped, bad ones null, no location to 'Unknown'."""
    checks = rules(df, fields)
    fixes: dict[str, Column] = {}
    if fields.posted in df.columns:
        day = F.date_format(as_of, "yyyy-MM-dd")
        fixes[fields.posted] = F.when(checks["invalid_date"], day).otherwise(F.col(fields.posted).cast("string"))
    if fields.salary_min in df.columns and fields.salary_max in df.columns:
        low, high = (F.col(n).cast("string").try_cast("double") for n in (fields.salary_min, fields.salary_max))
        crossed = low > high
        fixes[fields.salary_min] = F.when(crossed, high).otherwise(low)
        fixes[fields.salary_max] = F.when(crossed, low).otherwise(high)
    if fields.location in df.columns:
        fixes[fields.location] = F.when(checks["missing_location"], F.lit("Unknown")).otherwise(F.col(fields.location))
    return df.withColumns(fixes)
