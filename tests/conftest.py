import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from snapfeed.session import configure

    s = (SparkSession.builder.master("local[*]").appName("snapfeed-tests")
         .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    configure(s)
    yield s
    s.stop()


def one(spark, expr, value, schema="v string"):
    """Evaluate a Column expression over a one-row DataFrame with column ``v``."""
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]
