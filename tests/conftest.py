import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = session.build(
        "tests", "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    return session.tune(spark)


@pytest.fixture()
def frame(spark):
    """``frame("a long, b string", (1, "x"), ...)``; timestamps and dates given as text."""

    def make(ddl, *rows):
        from pyspark.sql import functions as F
        from pyspark.sql.types import DateType, StringType, StructField, StructType, TimestampNTZType, TimestampType

        wanted = StructType.fromDDL(ddl)
        kinds = (DateType, TimestampType, TimestampNTZType)
        text = StructType([StructField(f.name, StringType() if isinstance(f.dataType, kinds) else f.dataType) for f in wanted])
        df = spark.createDataFrame(list(rows), text)
        return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted))

    return make
