"""Tables kept as whole versions: a new version is written beside the old one, then named in a log.

Readers take the newest named version, so a job that dies half way leaves the table as it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from joblattice.sources.files import read_jobs, write_jobs

_LOG_DDL = "number bigint, path string, committed_at timestamp"


class Snapshots:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        write: Callable[[DataFrame, str], None] = write_jobs,
        read: Callable[[SparkSession, str], DataFrame] = read_jobs,
    ):
        self._spark, self._root, self._write, self._read = spark, root.rstrip("/"), write, read

    @property
    def _log(self) -> str:
        return f"{self._root}/versions"

    def history(self) -> DataFrame:
        """One row per version; empty before the first."""
        log = self._spark.read.schema(_LOG_DDL).option("ignoreMissingFiles", True)
        try:
            return log.parquet(self._log)
        except Exception as error:  # the log folder appears with the first version
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return self._spark.createDataFrame([], _LOG_DDL)

    def _newest(self):
        return self.history().orderBy(F.desc("number")).limit(1).collect()

    def exists(self) -> bool:
        return bool(self._newest())

    def read(self, number: int | None = None) -> DataFrame:
        """The newest version, or the numbered one."""
        rows = self._newest() if number is None else self.history().filter(F.col("number") == number).collect()
        if not rows:
            raise LookupError(f"no version {number if number is not None else ''} under {self._root}")
        return self._read(self._spark, rows[0]["path"])

    def commit(self, df: DataFrame, now: Column) -> int:
        """Write ``df`` as the next version and name it; returns its number."""
        newest = self._newest()
        number = newest[0]["number"] + 1 if newest else 1
        path = f"{self._root}/data/{number:06d}-{uuid.uuid4().hex[:8]}"
        self._write(df, path)
        entry = self._spark.range(1).select(
            F.lit(number).cast("bigint").alias("number"), F.lit(path).alias("path"), now.cast("timestamp").alias("committed_at")
        )
        entry.coalesce(1).write.mode("append").parquet(self._log)
        return number
