"""Salary, date, identity and quality expressions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from joblattice.constants import DEFAULT_CURRENCY, URL_NAMESPACE_HEX
from joblattice.functions.text import let, strip

# --- salary ------------------------------------------------------------------------------------


def format_salary(low: Column, high: Column, currency: Column | None = None, thousands: str = " ") -> Column:
    """``"45 000 - 60 000 EUR"``; null unless both ends are present and not zero."""
    currency = F.lit(None).cast("string") if currency is None else currency
    unit = F.coalesce(F.nullif(currency, F.lit("")), F.lit(DEFAULT_CURRENCY))

    def grouped(amount: Column) -> Column:
        return F.replace(F.format_number(amount.cast("bigint"), 0), F.lit(","), F.lit(thousands))

    return F.when((low != 0) & (high != 0), F.concat(grouped(low), F.lit(" - "), grouped(high), F.lit(" "), unit))


def parse_salary(c: Column, thousands: str = " ", checked: bool = False) -> Column:
    """Struct ``(salary_min, salary_max)`` over all runs of digits and blanks in the text.

    ``thousands=","`` also reads ``60,000`` as one number. ``checked`` nulls a range that is not
    above zero or runs backwards.
    """
    text = c.cast("string")
    if thousands != " ":
        text = F.replace(text, F.lit(thousands), F.lit(" "))
    runs = F.filter(F.regexp_extract_all(text, F.lit(r"(?U)[\d\s\x1c-\x1f]+"), F.lit(0)), lambda r: strip(r) != "")
    numbers = F.transform(runs, lambda r: F.replace(r, F.lit(" "), F.lit("")).try_cast("bigint"))

    def ends(n: Column) -> Column:
        low, high = F.array_min(n), F.array_max(n)
        if checked:
            fine = (low > 0) & (high >= low)
            low, high = F.when(fine, low), F.when(fine, high)
        return F.struct(low.alias("salary_min"), high.alias("salary_max"))

    return let(numbers, ends)


# --- dates -------------------------------------------------------------------------------------


def parse_timestamp(c: Column, formats: Sequence[str] = ()) -> Column:
    """ISO date or date-time text to a timestamp, then the given patterns; anything else is null."""
    text = strip(c.cast("string"))
    iso = F.when(F.rlike(text, F.lit(r"^\d{4}-\d{1,2}-\d{1,2}([T ].*)?$")), text.try_cast("timestamp"))
    return F.coalesce(iso, *[F.try_to_timestamp(text, F.lit(f)) for f in formats])


def parse_posted_date(c: Column, formats: Sequence[str] = ()) -> Column:
    """The day as written: an offset behind the time does not move it."""
    written = F.regexp_extract(strip(c.cast("string")), r"^(\d{4}-\d{1,2}-\d{1,2})(?:[T ].*)?$", 1).try_cast("date")
    return F.when(parse_timestamp(c).isNotNull(), written).otherwise(parse_timestamp(c, formats).cast("date"))


def days_since(posted: Column, as_of: Column) -> Column:
    """Whole days from the posted date to ``as_of``; negative for future dates."""
    return F.datediff(as_of, posted)


def model_version_name(ts: Column, prefix: str = "tfidf_v") -> Column:
    return F.concat(F.lit(prefix), F.date_format(ts, "yyyyMMdd_HHmmss"))


# --- identity ------------------------------------------------------------------------------------


def uuid5_of(*parts: Column, separator: str = "||") -> Column:
    """Name-based (SHA-1) UUID in the URL name space over the non-empty parts."""
    name = F.concat_ws(separator, *[F.nullif(p, F.lit("")) for p in parts])
    digest = F.sha1(F.concat(F.unhex(F.lit(URL_NAMESPACE_HEX)), F.encode(name, "UTF-8")))

    def layout(x: Column) -> Column:
        variant_byte = F.conv(F.substring(x, 17, 2), 16, 10).cast("int").bitwiseAND(63).bitwiseOR(128)
        return F.concat_ws(
            "-",
            F.substring(x, 1, 8),
            F.substring(x, 9, 4),
            F.concat(F.lit("5"), F.substring(x, 14, 3)),
            F.concat(F.lower(F.hex(variant_byte)), F.substring(x, 19, 2)),
            F.substring(x, 21, 12),
        )

    return let(digest, layout)


# --- quality ---------------------------------------------------------------------------------------


def quality_score(columns: Iterable[str]) -> Column:
    """Share of the given fields that are not null, 0.0 to 1.0."""
    flags = [F.col(c).isNotNull().cast("int") for c in columns]
    return sum(flags[1:], flags[0]) / F.lit(float(len(flags)))


def default_quality_score() -> Column:
    return F.lit(1.0)
