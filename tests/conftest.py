from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from joblattice.session import get_session


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g", "spark.sql.adaptive.enabled": "true"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def apply(spark):
    """Evaluate one column expression over a list of values, in order."""

    def run(values, expression, kind="string"):
        df = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
        return [r[0] for r in df.repartition(2).select("i", expression(F.col("v")).alias("out")).orderBy("i").select("out").collect()]

    return run


@pytest.fixture()
def folder(tmp_path):
    return str(tmp_path)
