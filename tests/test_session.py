from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from joblattice import session


def test_size_check_bounds_rows_and_bytes(spark):
    assert session.is_small(spark.range(10), 10) and not session.is_small(spark.range(11), 10)
    texts = spark.range(4).select(F.lit("abcde").alias("t"), F.array(F.lit(1)).alias("a"))
    assert session.is_small(texts, 10, 100) and not session.is_small(texts, 10, 20)
    assert session.is_small(texts.limit(0), 10, 0)


def test_size_check_stops_reading_early(spark):
    plan = spark.range(10).select(F.lit(1)).offset(5).limit(1)._jdf.queryExecution().executedPlan().toString()
    assert plan.startswith("CollectLimit 6, 5")


def test_large_frames_are_not_hinted(spark):
    big = session.broadcast_if_small(spark.range(11), 10)
    assert "broadcast" not in big._jdf.queryExecution().logical().toString().lower()


def test_shared_folder(spark, monkeypatch):
    first, second = session.scratch_path(spark, "x"), session.scratch_path(spark, "x")
    assert first != second and first.startswith(session.shared_dir(spark))
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert session.shared_dir(spark) == named


def test_a_cluster_has_to_name_its_folder():
    class Conf:
        def get(self, *_):
            return None

    class Cluster:
        conf = Conf()
        sparkContext = type("C", (), {"master": "yarn"})()

    with pytest.raises(ValueError):
        session.shared_dir(Cluster())


def test_cut_lineage(spark):
    cut = session.cut_lineage(spark.range(5).withColumn("r", F.rand()))
    assert cut.collect() == cut.collect()
    assert "rand" not in cut._jdf.queryExecution().executedPlan().toString()
