from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from clvspark.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=8, app_name="clvspark-tests")
    yield session
    session.stop()


def d(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def tx_frame(spark, rows):
    """Transactions from (customer_id, 'yyyy-mm-dd', price) tuples."""
    from pyspark.sql.types import (DateType, DoubleType, LongType, StructField, StructType)
    schema = StructType([StructField("customer_id", LongType()),
                         StructField("date", DateType()),
                         StructField("quantity", DoubleType()),
                         StructField("price", DoubleType())])
    data = [(c, d(day), 1.0, float(p)) for c, day, p in rows]
    return spark.createDataFrame(data, schema)
