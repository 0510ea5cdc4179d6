"""Scalar functions on hand-made cases."""

import datetime

import pytest
from pyspark.sql import functions as F

from wayfare.functions import geo, names, times


def values(spark, column, data, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(data)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(column(F.col("x"))).collect()]


def test_service_clock(spark):
    assert values(spark, times.hms24, ["7:10:00", "25:10:01", "14:00:30", " 04:00:00 "]) == [25800, 90601, 50430, 14400]
    assert values(spark, times.hms24, ["07:60:00", "7:10", "abc", "3:00:00", "26:00:00", "", None]) == [None] * 7


def test_strict_service_clock_raises(spark):
    with pytest.raises(Exception, match="not a service time"):
        values(spark, lambda c: times.hms24(c, strict=True), ["abc"])


def test_twelve_hour(spark):
    got = values(spark, times.twelve_hour, ["2025-05-06 오전 12:05:00", "2025-05-06 오후 12:00:00", "2025-05-06 오후 1:02:03", "0001-01-01", "2025-05-06 오전 13:00:00"])
    d = datetime.datetime
    assert got == [d(2025, 5, 6, 0, 5), d(2025, 5, 6, 12), d(2025, 5, 6, 13, 2, 3), None, None]
    assert values(spark, times.is_no_departure, ["0001-01-01", "2025-05-07 0:00", "x"]) == [True, True, False]


def test_service_seconds_keep_the_day(spark):
    df = spark.sql("SELECT timestamp_ntz'2025-05-07 01:30:00' AS t, date'2025-05-06' AS d, timestamp_ntz'2025-05-07 02:00:00' AS u")
    assert df.select(times.service_seconds(F.col("t"), F.col("d")), times.service_seconds(F.col("u"), F.col("d"))).first()[:] == (91800, None)


def test_tokens_and_lists(spark):
    assert values(spark, times.clock_token, ["23:59:59", "24:00:00", "5시 6분 7초", "24시 0분 0초", "5시 60분 0초"]) == [86399, None, 18367, None, None]
    assert values(spark, lambda c: times.time_list(c, times.clock_token, 14400), ["01:00:00|10:00:00", "5시 0분 0초"]) == [[90000, 36000], [18000]]


def test_names(spark):
    assert values(spark, names.base_name, ["50(a 방면)", "5 (x (y) z) ", "5", "a (b) c"]) == ["50", "5", "5", "a (b) c"]
    assert values(spark, lambda c: names.stop_name(c, {"A": "B"}), ["　A\t", " C "]) == ["B", "C"]
    assert values(spark, names.lineage, ["BR_ACC0_1", "BS_TAGO_2", "X_1"]) == ["ACC0", "TAGO", None]
    assert values(spark, lambda c: names.parent_name(c, "지원"), ["13 지원2"]) == ["13"]
    assert values(spark, lambda c: names.padded(c), [7, 1234], "int") == ["007", "1234"]
    with pytest.raises(ValueError, match="unknown rule kind"):
        names.rule_column("like:x", F.lit("x"))


def test_geometry(spark):
    df = spark.sql("SELECT 35.0D a, 129.0D b, 35.001D c, 129.0D d, 35.0D e, 129.001D f")
    n, e, z = df.select(geo.bearing(F.col("a"), F.col("b"), F.col("c"), F.col("d")), geo.bearing(F.col("a"), F.col("b"), F.col("e"), F.col("f")), geo.bearing(F.col("a"), F.col("b"), F.col("a"), F.col("b"))).first()
    assert abs(n) < 1e-9 and abs(e - 90) < 1e-3 and z == 0
    assert abs(df.select(geo.haversine(F.col("a"), F.col("b"), F.col("c"), F.col("d"))).first()[0] - 111.195) < 0.001
