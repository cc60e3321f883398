"""The jobs table by month, of which a batch rewrites only the months it touches.

A month's rows lie in a folder for each time they were written. A log names, for every version, the
months that changed and the write that holds them now; the other months stay where earlier versions
have put them. Readers take the folders of the newest version, so a job that dies half way leaves the
table as it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from joblattice.operators.tables import with_month
from joblattice.session import broadcast_if_small
from joblattice.sources.files import MONTH

_LOG_DDL = f"number bigint, {MONTH} date, written string, committed_at timestamp"
WRITE = "written"


class MonthlyTable:
    """``schema`` holds ``posted_date``; rows without one share a month of their own."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType):
        self._spark, self._root, self._schema = spark, root.rstrip("/"), schema

    def history(self) -> DataFrame:
        """One row for every month a version has changed; empty before the first."""
        try:
            return self._spark.read.schema(_LOG_DDL).parquet(f"{self._root}/versions")
        except Exception as error:  # the log folder appears with the first version
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return self._spark.createDataFrame([], _LOG_DDL)

    def folders(self, number: int | None = None) -> dict:
        """Month -> the folder that holds it, of the newest version or of the numbered one. One entry a month."""
        log = self.history() if number is None else self.history().filter(F.col("number") <= number)
        newest = log.groupBy(MONTH).agg(F.max_by(WRITE, "number").alias(WRITE)).filter(F.col(WRITE).isNotNull())
        return {r[MONTH]: self._folder(r[MONTH], r[WRITE]) for r in newest.collect()}

    def _folder(self, month, write: str) -> str:
        return f"{self._root}/data/{MONTH}={month or '__HIVE_DEFAULT_PARTITION__'}/{WRITE}={write}"

    def read(self, number: int | None = None, months: list | None = None) -> DataFrame:
        """The rows, and ``posted_month``; with ``months``, no folder of any other month is opened."""
        held = [f for m, f in self.folders(number).items() if months is None or m in months]
        kinds = T.StructType([*self._schema.fields, T.StructField(MONTH, T.DateType())])
        if not held:
            return self._spark.createDataFrame([], kinds).filter(F.lit(False))  # known to be empty, so nothing is joined with it
        full = T.StructType([*kinds.fields, T.StructField(WRITE, T.StringType())])
        return self._spark.read.schema(full).option("basePath", f"{self._root}/data").parquet(*held).drop(WRITE)

    def touched(self, batch: DataFrame, key: str) -> list:
        """The months a batch changes: those its keys stand in, and those of its own rows. One value a month."""
        held = self.read().select(key, MONTH)
        here = held.join(broadcast_if_small(batch.select(key)), key, "left_semi").select(MONTH)
        there = with_month(batch.select("posted_date"), "posted_date", MONTH).select(MONTH)
        return [r[0] for r in here.unionByName(there).distinct().collect()]

    def rewrite(self, months: list, now: Column, change: Callable[[DataFrame], DataFrame]) -> int:
        """The next version, with the rows of ``months`` changed and those months alone written; its number.

        ``change`` gets the present rows of the months; what it returns lies in these months too.
        """
        newest = self.history().agg(F.max("number")).first()[0] or 0
        write = f"{newest + 1:06d}-{uuid.uuid4().hex[:8]}"
        rows = with_month(change(self.read(months=months).drop(MONTH)), "posted_date", MONTH)
        placed = rows.hint("rebalance", F.col(MONTH)).sortWithinPartitions(MONTH, "posted_date").withColumn(WRITE, F.lit(write))
        placed.write.mode("append").partitionBy(MONTH, WRITE).parquet(f"{self._root}/data", compression="zstd")
        kept = [(newest + 1, m, write if self._exists(self._folder(m, write)) else None) for m in months]
        entry = self._spark.createDataFrame(kept, f"number bigint, {MONTH} date, written string")
        entry.withColumn("committed_at", now.cast("timestamp")).coalesce(1).write.mode("append").parquet(f"{self._root}/versions")
        return newest + 1

    def _exists(self, folder: str) -> bool:
        where = self._spark._jvm.org.apache.hadoop.fs.Path(folder)
        return where.getFileSystem(self._spark._jsc.hadoopConfiguration()).exists(where)
