"""CSV and parquet edges with explicit schemas."""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from joblattice.operators.rows import align_schema
from joblattice.operators.tables import with_month
from joblattice.schemas import RAW_JOBS


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType = RAW_JOBS, sequence: str | None = None) -> DataFrame:
    """UTF-8 CSV with a header; columns are matched to the schema by name, empty fields are null.

    Every file goes by its own header, which stands in one line; files with equal headers are read
    together. ``sequence`` adds a column that orders rows by file and position in the file.
    """
    lines = spark.read.text(path).where("_metadata.file_block_start = 0")
    lines = lines.select("value", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at"))
    heads = lines.groupBy("file").agg(F.min_by("value", "at").alias("header"))
    kinds = heads.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("header").collect()
    reader = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"')
    parts = [path] if len(kinds) < 2 else [[unquote(f) for f in kind.files] for kind in kinds]
    fields, out = list(schema.fields), []
    if sequence:
        fields.append(T.StructField(sequence, T.StructType().add("file", T.StringType()).add("row", T.LongType())))
    for part in parts:
        rows = reader.csv(part)
        if sequence:
            order = F.struct(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("row"))
            rows = rows.withColumn(sequence, order)
        out.append(align_schema(rows, T.StructType(fields)))
    return reduce(DataFrame.unionByName, out)


def with_sequence(df: DataFrame, name: str = "_seq") -> DataFrame:
    """Numbers rows in file order. Write the result down before using it: the numbers follow the read partitions."""
    return df.withColumn(name, F.monotonically_increasing_id())


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """UTF-8 CSV with a header; blanks at the ends of a text are kept. An empty text reads back as null."""
    writer = df.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def append_table(df: DataFrame, path: str) -> None:
    """Bulk load: the rows are added as they are."""
    df.write.mode("append").parquet(path)


MONTH = "posted_month"


def write_jobs(jobs: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Jobs by month of posting, sorted by date inside a file so that date filters skip row groups.

    The rebalance hint lets adaptive execution put small months together and split a big one.
    """
    monthly = with_month(jobs, "posted_date", MONTH).hint("rebalance", F.col(MONTH))
    monthly.sortWithinPartitions(MONTH, "posted_date").write.mode(mode).partitionBy(MONTH).parquet(path)


def read_jobs(spark: SparkSession, path: str, since: str | None = None) -> DataFrame:
    """The jobs table; ``since`` (an ISO date) also prunes the months before it. Undated rows need no ``since``."""
    jobs = spark.read.parquet(path)
    if since is not None:
        day = F.lit(since).cast("date")
        jobs = jobs.filter((F.col(MONTH) >= F.trunc(day, "MM")) & (F.col("posted_date") >= day))
    return jobs.drop(MONTH)
