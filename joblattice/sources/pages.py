"""Landed API pages to raw listings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from joblattice.constants import DEFAULT_SOURCE
from joblattice.functions.values import format_salary, uuid5_of
from joblattice.operators.rows import align_schema
from joblattice.schemas import API_PAGE, RAW_JOBS
from joblattice.session import broadcast_if_small, cut_lineage

SEARCH = ["query", "location"]


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(API_PAGE).json(path)


def _hits_on(page_results: Column) -> Column:
    return F.coalesce(F.size(page_results), F.lit(0))


def before_first_empty(pages: DataFrame) -> DataFrame:
    """Pages before the first page without hits of their search; a failed page counts as empty.

    The page numbers alone are aggregated, so the hits of a big search are not brought together; the
    stops are written down, since finding them reads all pages.
    """
    empty = pages.groupBy(*SEARCH).agg(F.min(F.when(_hits_on(F.col("results")) == 0, F.col("page"))).alias("stop"))
    found = empty.filter(F.col("stop").isNotNull()).withColumnsRenamed({"query": "stop_query", "location": "stop_location"})
    stops = broadcast_if_small(cut_lineage(found))
    same = F.col("query").eqNullSafe(F.col("stop_query")) & F.col("location").eqNullSafe(F.col("stop_location"))
    return pages.join(stops, same & (F.col("page") >= F.col("stop")), "left_anti")


def explode_hits(pages: DataFrame) -> DataFrame:
    """One row per hit with its search, page number and position on the page."""
    return pages.select(*SEARCH, "page", F.posexplode("results").alias("pos", "hit"))


_PAGE_BLOCK = 1024


def _cuts(pages: DataFrame, limit: int) -> DataFrame:
    """(cut_query, cut_location, cut_page, rest): the page on which a search reaches the limit, and its hits that still count.

    Sums run over blocks of pages, then over the pages of one block, so no task sorts all pages of a search.
    """
    before, hits = F.col("before"), F.col("hits")
    reached = (before < limit) & (before + hits >= limit)
    sizes = pages.groupBy(*SEARCH, _number().alias("number")).agg(F.sum(_hits_on(F.col("results"))).alias("hits"))
    sizes = cut_lineage(sizes.withColumn("block", F.floor(F.col("number") / _PAGE_BLOCK)))
    blocks = sizes.groupBy(*SEARCH, "block").agg(F.sum("hits").alias("hits"))
    over = Window.partitionBy(*SEARCH)
    blocks = blocks.withColumn("before", F.sum("hits").over(over.orderBy("block")) - hits).filter(reached)
    found = blocks.select(*[F.col(c).alias(f"cut_{c}") for c in (*SEARCH, "block")], "before")
    inside = sizes.join(found, _same_search() & (F.col("block") == F.col("cut_block")))
    inside = inside.withColumn("before", before + F.sum("hits").over(over.orderBy("number")) - hits).filter(reached)
    return inside.select("cut_query", "cut_location", F.col("number").alias("cut_page"), (F.lit(limit) - before).alias("rest"))


def _number() -> Column:
    """Pages without a number come first."""
    return F.coalesce(F.col("page"), F.lit(-1))


def _same_search() -> Column:
    return F.col("query").eqNullSafe(F.col("cut_query")) & F.col("location").eqNullSafe(F.col("cut_location"))


def limit_pages(pages: DataFrame, limit: int) -> DataFrame:
    """The pages with the first ``limit`` hits of every search; the last one is cut short.

    Hits are neither ranked nor shuffled: page sizes are summed, and the few cut pages meet the rest.
    A page number that has landed more than once counts copy by copy.
    """
    if limit < 1:
        return pages.filter(F.lit(False))
    met = pages.join(broadcast_if_small(cut_lineage(_cuts(pages, limit))), _same_search(), "left")
    whole = met.filter(F.col("cut_page").isNull() | (_number() < F.col("cut_page")))
    copies = Window.partitionBy(*SEARCH).orderBy(F.xxhash64("results"), F.monotonically_increasing_id())
    earlier = F.coalesce(F.sum(_hits_on(F.col("results"))).over(copies.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.greatest(F.col("rest") - earlier, F.lit(0)).cast("int")
    last = met.filter(_number() == F.col("cut_page")).withColumn("left", left)
    last = last.withColumn("results", F.slice("results", F.lit(1), F.col("left")))
    return whole.select(*pages.columns).unionByName(last.select(*pages.columns))


def to_raw_rows(hits: DataFrame, source: str = DEFAULT_SOURCE, locations: Sequence[str] = ()) -> DataFrame:
    """Raw 11-column rows plus ``_seq``, which orders them by place in ``locations``, search, page and position.

    Unlisted locations come first, by name.
    """
    hit = lambda name: F.col(f"hit.{name}")
    company, place = hit("company.display_name"), hit("location.display_name")
    listed = F.array_position(F.array(*[F.lit(x) for x in locations]).cast("array<string>"), F.col("location"))
    place_listed = F.coalesce(listed, F.lit(0)).cast("int").alias("place")
    rows = hits.select(
        uuid5_of(F.lit(source), hit("id"), hit("redirect_url"), hit("title"), company).alias("job_id"),
        hit("title").alias("job_title"),
        company.alias("company_name"),
        place.alias("location"),
        hit("created").alias("posted_date"),
        hit("description").alias("job_description"),
        F.lit(None).cast("string").alias("skills_required"),
        format_salary(hit("salary_min"), hit("salary_max"), hit("salary_currency")).alias("salary_range"),
        hit("redirect_url").alias("url"),
        F.lit(source).alias("source"),
        F.col("query").alias("search_query"),
        F.struct(place_listed, "location", "query", "page", "pos").alias("_seq"),
    )
    return rows


def collect_jobs(
    pages: DataFrame,
    limit: int,
    source: str = DEFAULT_SOURCE,
    locations: Sequence[str] = (),
) -> DataFrame:
    """Raw rows of all searches: pages up to the first empty one, at most ``limit`` hits per search."""
    return to_raw_rows(explode_hits(limit_pages(before_first_empty(pages), limit)), source, locations)


def unify_schema(rows: DataFrame) -> DataFrame:
    return align_schema(rows, RAW_JOBS)
