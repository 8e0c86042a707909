import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickerlens.functions import timefn as T


def _one(spark, s):
    return spark.createDataFrame([(s,)], "s string").select(F.to_timestamp_ntz("s").alias("t"))


def test_iso_week_year_ends(spark):
    for s, exp in [("2016-01-02 12:00:00", (2015, 53)), ("2014-12-29 00:00:00", (2015, 1))]:
        r = _one(spark, s).select(*T.grain_parts("t", "WEEK")).first()
        assert (r.year, r.week) == exp
    r = _one(spark, "2016-01-02 12:00:00").select(*T.grain_parts("t", "WEEK", week_year="calendar")).first()
    assert (r.year, r.week) == (2016, 53)


def test_grains_and_bucket_roundtrip(spark):
    df = _one(spark, "2016-01-02 10:11:12")
    for g in T.GRAINS:
        parts = df.select(*T.grain_parts("t", g))
        back = parts.select(T.parts_to_timestamp(g).alias("b")).first().b
        assert back == df.select(T.bucket_start("t", g).alias("b")).first().b
    with pytest.raises(ValueError):
        T.normalize_grain("FORTNIGHT")


def test_post_time_parse_skips_offset(spark):
    df = spark.createDataFrame([("Wed Jan 28 13:08:45 +0530 2015",)], "c string")
    assert df.select(T.parse_post_time("c")).first()[0] == dt.datetime(2015, 1, 28, 13, 8, 45)


def test_oslo_to_pacific_and_dst_gap(spark):
    df = spark.createDataFrame([("2015-02-02 15:30:01",), ("2015-03-10 12:00:00",), ("2015-03-30 12:00:00",)],
                               "s string")
    out = [r[0] for r in df.select(T.parse_trade_time("s")).collect()]
    assert out[0] == dt.datetime(2015, 2, 2, 6, 30, 1)
    assert out[1] == dt.datetime(2015, 3, 10, 4, 0, 0)   # 8 h between the two DST changes
    assert out[2] == dt.datetime(2015, 3, 30, 3, 0, 0)   # 9 h again


def test_eastern_hour_guard():
    assert T.local_hour_to_utc("2015_02_02_10") == dt.datetime(2015, 2, 2, 15)
    with pytest.raises(ValueError, match="does not exist"):
        T.local_hour_to_utc("2015_03_08_02")
    with pytest.raises(ValueError, match="ambiguous"):
        T.local_hour_to_utc("2015_11_01_01")


def test_strict_column_conversion_raises(spark):
    ok = _one(spark, "2015-02-02 10:00:00").select(T.local_to_utc_strict("t", "America/New_York")).first()[0]
    assert ok == dt.datetime(2015, 2, 2, 15)
    for bad in ("2015-03-08 02:30:00", "2015-11-01 01:30:00"):
        with pytest.raises(Exception, match="ambiguous or non-existent"):
            _one(spark, bad).select(T.local_to_utc_strict("t", "America/New_York")).collect()


def test_floor_minutes_and_epochs(spark):
    df = _one(spark, "2013-01-04 10:23:59")
    r = df.select(T.floor_minutes("t", 15).alias("a"), T.floor_minutes("t", 0).alias("b"),
                  T.local_to_epoch_millis("t", "UTC").alias("ms"),
                  T.local_to_epoch_millis("t", "America/Los_Angeles").alias("pms")).first()
    assert (r.a, r.b) == ("20130104101500", "2013-01-04")
    assert r.ms == 1357295039000 and r.pms - r.ms == 8 * 3600 * 1000
    e = spark.range(1).select(T.epoch_to_local(F.lit(1422282899), "America/Los_Angeles")).first()[0]
    assert e == dt.datetime(2015, 1, 26, 6, 34, 59)
    with pytest.raises(ValueError):
        T.floor_minutes("t", 7)
