"""Duration text -> minutes truth table (FIXTURES.md §4)."""

import pytest
from pyspark.errors import ArithmeticException, NumberFormatException
from pyspark.sql import functions as F

from stratum.functions.duration import duration_minutes

CASES = [
    ("24 min per ep", 24.0),
    ("1 hr 30 min per ep", 90.0),
    ("1 hr 45 min", 105.0),
    ("24 min", 24.0),
    ("2 min 30 sec", 2.0),
    ("1 hr 2 min 30 sec", 62.0),
    ("30 sec per ep", 0.5),
    ("2 hr", 120.0),
    ("1 hr per ep", 60.0),
    ("Unknown", None),
    (None, None),
    ("", None),
    ("24 MIN", None),
]


def test_truth_table(spark):
    df = spark.createDataFrame(CASES, "duration string, expected float")
    got = df.select("duration", "expected", duration_minutes("duration").alias("m")).collect()
    for r in got:
        if r.expected is None:
            assert r.m is None, r
        else:
            assert r.m == pytest.approx(r.expected), r
    assert dict(df.select(duration_minutes("duration")).dtypes)  # float column
    assert df.select(duration_minutes("duration").alias("m")).schema["m"].dataType.typeName() == "float"


def test_strict_raises_lenient_nulls(spark):
    df = spark.createDataFrame([("1 hr 30 sec",)], "duration string")
    assert df.select(duration_minutes("duration", strict=False).alias("m")).first().m is None
    with pytest.raises(Exception):
        df.select(duration_minutes("duration", strict=True).alias("m")).collect()
