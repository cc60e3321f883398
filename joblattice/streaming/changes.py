"""A log of streamed changes that folds itself, so that reading it does not grow with the number of micro-batches.

Keys are dealt by hash into slices. A micro-batch is written with one row a key; after it, the slice whose
turn it is gets its last fold and the micro-batches since put together as its next fold. With ``n`` slices
every micro-batch rewrites one n-th of the keys, and a reader opens one fold and at most ``n - 1``
micro-batches of each slice. Which fold a slice has follows from the number of the newest micro-batch alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from joblattice.operators.tables import as_job_rows, upsert
from joblattice.streaming.flows import EPOCH

SLICE, FIRST, LAST = "_slice", "_first", "_last"


class ChangeLog:
    """Changes of ``schema``, which holds ``key`` and ``order``, under ``root``; one stream writes it.

    A key's row holds the values of its first change, and in ``update_columns`` those of its last one, by
    micro-batch and then ``order``: what an upsert of all its changes takes from them. Rows without a key
    are left out, as an upsert does.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: T.StructType,
        key: str,
        order: str,
        update_columns: Sequence[str],
        slices: int = 16,
    ):
        self._spark, self._root, self._key, self._order, self._slices = spark, root.rstrip("/"), key, order, slices
        self._updated = tuple(update_columns)
        self._kept = [f.name for f in schema.fields if f.name not in (key, order, *self._updated)]
        at = T.StructType().add(EPOCH, T.LongType()).add("at", schema[order].dataType)
        values = [schema[name] for name in (key, *self._kept, *self._updated)]
        self._schema = T.StructType([*values, T.StructField(FIRST, at), T.StructField(LAST, at), T.StructField(SLICE, T.IntegerType())])

    def drain(self, changes: DataFrame) -> None:
        """Run a stream of changes over everything landed; its progress is kept beside the log."""
        query = (
            changes.writeStream.option("checkpointLocation", f"{self._root}/progress")
            .trigger(availableNow=True)
            .foreachBatch(self.add)
            .start()
        )
        query.awaitTermination()

    def add(self, batch: DataFrame, number: int) -> None:
        """Write one micro-batch and fold the slice whose turn it is. A micro-batch given again changes nothing."""
        newest = self.newest()
        if newest is not None and number <= newest:
            return
        at = F.struct(F.lit(number).cast("bigint").alias(EPOCH), F.col(self._order).alias("at"))
        slice_of = F.pmod(F.xxhash64(self._key), F.lit(self._slices)).cast("int")
        rows = batch.withColumns({FIRST: at, LAST: at, SLICE: slice_of}).filter(F.col(self._key).isNotNull())
        self._folded(rows).write.mode("overwrite").partitionBy(SLICE).parquet(self._path("log", number))
        turn = number % self._slices
        self._folded(self._rows_of(turn, number - self._slices, number)).write.mode("overwrite").parquet(self._path("fold", number))
        self._spark.range(1).write.mode("overwrite").parquet(self._path("done", number))

    def newest(self) -> int | None:
        """The number of the newest micro-batch that is whole; none before the first."""
        where = self._spark._jvm.org.apache.hadoop.fs.Path(f"{self._root}/done")
        files = where.getFileSystem(self._spark._jsc.hadoopConfiguration())
        if not files.exists(where):
            return None
        marked = (entry.getPath() for entry in files.listStatus(where))
        whole = (p.getName() for p in marked if files.exists(self._spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))
        return max((int(name.partition("=")[2]) for name in whole), default=None)

    def fold_of(self, part: int, newest: int) -> int:
        """The micro-batch after which a slice was folded last; below zero before its first fold."""
        return newest - (newest - part) % self._slices

    def read(self) -> DataFrame:
        """One row for every changed key, with ``_first`` and ``_last``, the places of its first and last change."""
        newest = self.newest()
        if newest is None:
            return self._spark.createDataFrame([], self._schema).drop(SLICE)
        parts = [self._rows_of(part, self.fold_of(part, newest), newest) for part in range(self._slices)]
        return self._folded(reduce(DataFrame.unionByName, parts)).drop(SLICE)

    def current_table(self, base: DataFrame, now: Column | None = None) -> DataFrame:
        """The base table with all changes applied; for a jobs table, clean listings get the values an insert gives."""
        changes = self.read().drop(FIRST).withColumnRenamed(LAST, self._order)
        if "data_quality_score" in base.columns and "data_quality_score" not in changes.columns:
            changes = as_job_rows(changes, F.current_timestamp() if now is None else now)
        return upsert(base, changes, self._key, self._order, self._updated)

    def _path(self, kind: str, number: int) -> str:
        return f"{self._root}/{kind}/{EPOCH}={number}"

    def _rows_of(self, part: int, fold: int, newest: int) -> DataFrame:
        """A slice's rows: its fold, if it has one, and the micro-batches after it; no other slice's files are read."""
        reader = self._spark.read.schema(self._schema)
        logs = [self._path("log", n) for n in range(max(fold + 1, 0), newest + 1)]
        parts = [reader.parquet(self._path("fold", fold))] if fold >= 0 else []
        # Each micro-batch is a table of its own, so that its number is no column.
        parts += [reader.parquet(path).filter(F.col(SLICE) == part) for path in logs]
        return reduce(DataFrame.unionByName, parts)

    def _folded(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(SLICE, self._key).agg(
            *[F.min_by(name, FIRST).alias(name) for name in self._kept],
            *[F.max_by(name, LAST).alias(name) for name in self._updated],
            F.min(FIRST).alias(FIRST),
            F.max(LAST).alias(LAST),
        )
