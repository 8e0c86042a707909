import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import make_posts
from tickerlens.functions.timefn import GRAINS
from tickerlens.operators import bars as B
from tickerlens.operators import mentions as M
from tickerlens.schemas import TRADE
from tickerlens.sources import fixtures as FX

T0 = "Wed Jan 28 13:08:45 +0000 2015"
T1 = "Wed Jan 28 13:59:00 +0000 2015"


def test_ties_keep_both_ticker_ascending(spark):
    posts = make_posts(spark, [(1, T0, "$BB good"), (2, T1, "$AA"), (3, T1, "$CC $CC")])
    r = M.trending(posts, "HR").orderBy("rank").collect()
    assert [(x.ticker, x.frequency, x.rank) for x in r] == [("CC", 2, 1), ("AA", 1, 2), ("BB", 1, 3)]
    d = M.trending(posts, "HR", distinct_frequency=True).orderBy("rank").collect()
    assert [x.ticker for x in d] == ["CC", "AA"]


def test_extremes_are_per_post(spark):
    posts = make_posts(spark, [(1, T0, "$AA good good"), (2, T0, "$AA good"), (3, T0, "$BB sell")])
    pos = M.sentiment_extremes(posts, "DAY", k=2).orderBy("rank").collect()
    assert [(x.ticker, x.sentiment) for x in pos] == [("AA", 2), ("AA", 1)]
    neg = M.sentiment_extremes(posts, "DAY", k=1, positive=False).collect()
    assert [(x.ticker, x.sentiment) for x in neg] == [("BB", -1)]


def test_frequency_total_equal_at_every_grain(spark, sf_dir):
    posts = FX.posts_from_events(FX.events(spark, sf_dir))
    totals = {g: M.mention_series(posts, g).agg(F.sum("frequency")).first()[0] for g in GRAINS}
    assert len(set(totals.values())) == 1


def test_join_form_equals_one_pass(spark, sf_dir):
    posts = FX.posts_from_events(FX.events(spark, sf_dir))
    a = M.mention_series(posts, "DAY")
    b = M.mention_series_join_form(posts, "DAY")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _trades(spark, rows):
    return spark.createDataFrame([(t, dt.datetime.fromisoformat(s), p, q, n) for t, s, p, q, n in rows], TRADE)


def test_numeric_high_low_and_sequence_order(spark):
    t = _trades(spark, [("X", "2015-02-02 15:30:01", 99.5, 1.0, 2), ("X", "2015-02-02 15:30:01", 100.2, 2.0, 1),
                        ("X", "2015-02-02 15:30:59", 100.0, 3.0, 3)])
    r = B.price_bars(t, "MIN").first()
    assert (r.high, r.low, r.open, r.close, r.volume) == (100.2, 99.5, 100.2, 100.0, 6.0)
    assert (r.hour, r.minute) == (6, 30)  # Oslo 15:30 is Pacific 06:30


def test_ties_null_prices_and_the_fold(spark):
    rows = [("X", "2015-02-02 15:30:01", float(i), 1.0, 7) for i in range(8)]
    for order in (rows, rows[::-1], rows[3:] + rows[:3]):
        r = B.price_bars(_trades(spark, order), "MIN").first()
        assert (r.open, r.close) == (0.0, 7.0)
    r = B.price_bars(_trades(spark, [("X", "2015-02-02 15:30:01", None, 1.0, 1), ("X", "2015-02-02 15:30:02", 5.0, 1.0, 2),
                                     ("X", "2015-02-02 15:30:03", None, 1.0, 3)]), "MIN").first()
    assert (r.open, r.close, r.high, r.volume) == (5.0, 5.0, 5.0, 3.0)
    # 2015-11-01: 08:30Z is 01:30 Pacific before the fold, 09:10Z 01:10 after it.
    r = B.price_bars(_trades(spark, [("X", "2015-11-01 09:30:00", 1.0, 1.0, 1), ("X", "2015-11-01 10:10:00", 2.0, 1.0, 2)]), "HR").collect()
    assert [(x.hour, x.open, x.close) for x in r] == [(1, 1.0, 2.0)]
    none = B.price_bars(_trades(spark, rows[:1]).withColumn("time", F.lit(None).cast("timestamp_ntz")), "MIN")
    assert none.count() == 0 == B.price_bars_join_form(_trades(spark, rows[:1]).withColumn("time", F.lit(None).cast("timestamp_ntz")), "MIN").count()


def test_bar_properties_and_rollup(spark, sf_dir):
    trades = FX.trades_from_events(FX.events(spark, sf_dir))
    m = B.price_bars(trades, "MIN")
    bad = m.where((F.col("low") > F.col("open")) | (F.col("open") > F.col("high")) |
                  (F.col("low") > F.col("close")) | (F.col("close") > F.col("high")))
    assert bad.count() == 0
    keys = ["ticker", "year", "month", "day", "hour"]
    rolled = (m.withColumn("o", F.struct("minute")).groupBy(*keys)
              .agg(F.max("high").alias("high"), F.min("low").alias("low"), F.min_by("open", "o").alias("open"),
                   F.max_by("close", "o").alias("close"), F.sum("volume").alias("volume")))
    hr = B.price_bars(trades, "HR")
    assert rolled.exceptAll(hr).count() == 0 and hr.count() == rolled.count()


def test_join_form_bars_equal(spark, sf_dir):
    trades = FX.trades_from_events(FX.events(spark, sf_dir))
    a, b = B.price_bars(trades, "DAY"), B.price_bars_join_form(trades, "DAY").select(*B.price_bars(trades, "DAY").columns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_backfill_only_touches_requested_day(spark, sf_dir):
    trades = FX.trades_from_events(FX.events(spark, sf_dir))
    bars = B.price_bars(trades, "MIN")
    out = B.backfill_bars(bars, FX.backup_bars_from_trades(trades), day=15)
    other = out.where(F.col("day") != 15)
    assert other.exceptAll(bars.where(F.col("day") != 15)).count() == 0
    day = out.where(F.col("day") == 15)
    assert day.where(F.col("volume") != F.floor("volume")).count() == 0
    assert day.count() >= bars.where(F.col("day") == 15).count()


def test_single_symbol_backup_needs_ticker(spark):
    import pytest

    backup = spark.createDataFrame([(1422282899, 113.2751, 113.74, 113.13, 113.74, 3494600.0)],
                                   "epoch long, close double, high double, low double, open double, volume double")
    with pytest.raises(ValueError):
        B.backup_to_minute_bars(backup)
    r = B.backup_to_minute_bars(backup, "America/Los_Angeles", day=26, ticker="MSFT").first()
    assert (r.ticker, r.day, r.hour, r.minute, r.close) == ("MSFT", 26, 6, 34, 113.2751)
    assert B.backup_to_minute_bars(backup, day=27, ticker="MSFT").count() == 0


def test_series_fold_to_coarser_grains(spark, sf_dir):
    posts = FX.posts_from_events(FX.events_over_years(FX.events(spark, sf_dir)))
    day = M.mention_series(posts, "DAY")
    for grain in ("WEEK", "MONTH", "YEAR"):
        want, got = M.mention_series(posts, grain), M.fold_series(day, "DAY", grain)
        assert want.exceptAll(got).count() == 0 and got.exceptAll(want).count() == 0
    for grain, to in (("WEEK", "MONTH"), ("MONTH", "WEEK"), ("DAY", "HR"), ("WEEK", "YEAR")):
        with pytest.raises(ValueError):
            M.fold_series(day, grain, to)
