import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.log.level", "ERROR")
        .getOrCreate()
    )
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Value of a column expression over one text."""
    from pyspark.sql import functions as F

    def run(fn, *texts):
        rows = [(i, t) for i, t in enumerate(texts)]
        df = spark.createDataFrame(rows, "i INT, t STRING").repartition(1)
        found = {r[0]: r[1] for r in df.select("i", fn(F.col("t")).alias("v")).collect()}
        values = [found[i] for i in range(len(texts))]
        return values[0] if len(values) == 1 else values

    return run


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
