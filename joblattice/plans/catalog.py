"""Named queries over the supplied tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


class Tables:
    """The parquet tables of one folder, read when named."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))


@dataclass(frozen=True)
class Query:
    build: Callable[[Tables], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None):
    """Register a function of ``Tables`` under its own name."""

    def register(build: Callable[[Tables], DataFrame]):
        if build.__name__ in QUERIES:
            raise ValueError(f"query {build.__name__} is registered twice")
        QUERIES[build.__name__] = Query(build, sql)
        return build

    return register


def load() -> dict[str, Query]:
    """All registered queries."""
    from joblattice.plans import model_queries, report_queries, row_queries, stream_queries, text_queries  # noqa: F401

    return dict(QUERIES)


# --- pieces the checking SQL shares ----------------------------------------------------------------

SQL_BLANK = r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def sql_clean_text(column: str) -> str:
    bare = f"regexp_replace({column}, '<[^>]+>', '', 'g')"
    return f"nullif(trim(regexp_replace({bare}, '[{SQL_BLANK}]+', ' ', 'g')), '')"


def sql_ascii_words(column: str) -> str:
    r"""Lower-case text in which every other letter or digit is a capital Z, so that an ASCII \b is a full one."""
    letters = f"regexp_replace(lower({column}), '[^\\x00-\\x7F\\P{{L}}]', 'Z', 'g')"
    return f"regexp_replace({letters}, '[^\\x00-\\x7F\\P{{N}}]', 'Z', 'g')"


def sql_skill_tokens(column: str) -> str:
    return f"regexp_extract_all({sql_ascii_words(f'coalesce({column}, {sql_text(str())})')}, '\\b[a-z0-9+\\-.#]{{2,}}\\b')"


def sql_word_tokens(column: str) -> str:
    full = rf"[^{SQL_BLANK}]"
    links = rf"https?://{full}+|www\.{full}+|{full}+@{full}+"
    return f"regexp_extract_all(regexp_replace(lower(coalesce({column}, '')), '{links}', ' ', 'g'), '[a-z]{{2,}}')"
