"""Serving queries over the result tables (SRV-1..5, AGG-13, FLT-10, SET-5).

The reference ran these as string-built store queries plus per-row Python
loops; here each is a DataFrame expression whose filters reach the scan of
the (partitioned) result table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickerlens.functions.text import colour, sentiment_sign, strip_quotes
from tickerlens.functions.timefn import (convert_zone, display_shift, format_local_time, grain_columns, local_hour_to_utc,
                                         local_to_epoch_millis, parse_post_time, parts_label,
                                         parts_to_timestamp, _epoch_ntz)
from tickerlens.operators.keyed import latest_per_key

SERIES_VALUES = ("frequency", "sentiment")


def live_panel(snapshots: DataFrame, n: int = 5) -> DataFrame:
    """Newest snapshot rows (ranks 0..n-1, newest first), coloured, then
    re-ordered by ascending frequency with a stable tie order (SRV-1, FLT-7,
    SRT-4, SRT-6, MTH-3). ``orderBy().limit()`` is a TakeOrdered: no full sort."""
    newest = (snapshots.where(F.col("id").between(0, n - 1))
              .orderBy(F.desc("timestamp"), F.asc("id")).limit(n)
              .withColumn("_newest_pos", F.row_number().over(
                  Window.orderBy(F.desc("timestamp"), F.asc("id")))))
    w = Window.orderBy(F.asc("frequency"), F.asc("_newest_pos"))
    return newest.select(F.row_number().over(w).cast("long").alias("position"), "ticker", "frequency",
                         colour(F.col("sentiment")).alias("colour"))


def recent_posts(posts: DataFrame, n: int = 10) -> DataFrame:
    """The n newest posts with author and unpadded ``y-m-d h:m:s`` time (SRV-1, SRV-2, DAT-13)."""
    ts = parse_post_time(F.col("created_at"))
    newest = (posts.select("id", strip_quotes(F.col("user.name")).alias("user"), "text", ts.alias("ts"))
              .orderBy(F.desc("ts"), F.desc("id")).limit(n))
    return newest.select("id", "user", "text",
                         F.concat_ws("-", F.year("ts"), F.month("ts"), F.dayofmonth("ts")).alias("_d"),
                         F.concat_ws(":", F.hour("ts"), F.minute("ts"), F.second("ts")).alias("_t")) \
        .select("id", "user", "text", F.concat_ws(" ", "_d", "_t").alias("time"))


def trending_at(trending_hour: DataFrame, label: str, tz: str = "America/New_York", n: int = 10) -> DataFrame:
    """Top n of one local hour ``YYYY_MM_DD_HH`` of an hourly ranking (SRV-3).

    The hour is converted to UTC first; a non-existent or ambiguous local hour
    raises (DAT-12). The UTC parts become literal filters, so a table
    partitioned by time parts is pruned to one partition (FLT-6)."""
    utc = local_hour_to_utc(label, tz)
    c = F.col
    hit = trending_hour.where((c("year") == utc.year) & (c("month") == utc.month) &
                              (c("day") == utc.day) & (c("hour") == utc.hour))
    return (hit.orderBy(F.desc("frequency"), F.asc("ticker")).limit(n)
            .select("ticker", "frequency", colour(c("sentiment")).alias("colour")))


def trending_by_local_hour(trending_hour: DataFrame, tz: str = "America/New_York", n: int = 10) -> DataFrame:
    """Every hour of an hourly ranking labelled in local time ``tz``, top n
    each, coloured: the whole-table form of SRV-3.

    Where one hour stops the scalar form, the two hours of an autumn fold stay
    here and are told apart (DAT-12): their labels end in the hours from UTC,
    as in ``2024_11_03_01-04`` and ``2024_11_03_01-05``."""
    utc = parts_to_timestamp("HR")
    local = convert_zone(utc, "UTC", tz)
    twice = reduce(lambda a, b: a | b, [convert_zone(utc + F.expr(f"INTERVAL {h} HOUR"), "UTC", tz) == local for h in (-1, 1)])
    off = F.timestamp_diff("HOUR", utc, local)
    mark = F.when(twice, F.concat(F.when(off < 0, "-").otherwise("+"), F.lpad(F.abs(off).cast("string"), 2, "0"))).otherwise("")
    w = Window.partitionBy("year", "month", "day", "hour").orderBy(F.desc("frequency"), F.asc("ticker"))
    ranked = trending_hour.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n)
    label = F.concat(F.regexp_replace(F.substring(format_local_time(local), 1, 13), "[- ]", "_"), mark)
    return ranked.select(label.alias("local_hour"), "ticker", "frequency",
                         colour(F.col("sentiment")).alias("colour"), F.col("_r").cast("long").alias("rank"))


def mention_chart(series_min: DataFrame, ticker: str | None = None) -> DataFrame:
    """Count and sign series, epoch ms ascending (SRV-4, FLT-5, DAT-10, MTH-2, SRT-5).
    ``ticker=None`` charts every ticker."""
    s = series_min if ticker is None else series_min.where(F.col("ticker") == ticker)
    ms = local_to_epoch_millis(parts_to_timestamp("MIN"), "UTC")
    return (s.select("ticker", ms.alias("epoch_ms"), "frequency",
                     sentiment_sign(F.col("sentiment")).alias("sign"))
            .orderBy("ticker", "epoch_ms"))


def with_position(ordered: DataFrame, *keys: str) -> DataFrame:
    """``ordered`` with ``position`` 1.. within ``keys``, in the order in which
    its rows come out (not one that is asked for anew)."""
    placed = ordered.withColumn("_place", F.monotonically_increasing_id())
    position = F.row_number().over(Window.partitionBy(*keys).orderBy("_place"))
    return placed.withColumn("position", position.cast("long")).drop("_place")


def chart_points(chart: DataFrame, y_cols=("frequency",)) -> DataFrame:
    """Each chart row as a JSON tuple ``[epoch_ms, y...]`` (ARR-3, JSN-2)."""
    return chart.select("ticker", "epoch_ms",
                        F.to_json(F.array(F.col("epoch_ms"), *[F.col(c).cast("long") for c in y_cols])).alias("point"))


PRICES = ("open", "high", "low", "close")


def bars_on_axis(bars_min: DataFrame, bars_tz: str = "America/Los_Angeles") -> DataFrame:
    """Minute bars by (ticker, epoch ms); their wall clock is in ``bars_tz`` (DAT-11)."""
    return bars_min.select("ticker", local_to_epoch_millis(parts_to_timestamp("MIN"), bars_tz).alias("epoch_ms"), *PRICES)


def mentions_on_axis(series_min: DataFrame) -> DataFrame:
    """A minute series by (ticker, epoch ms) (DAT-10)."""
    return series_min.select("ticker", local_to_epoch_millis(parts_to_timestamp("MIN"), "UTC").alias("epoch_ms"),
                             F.col("frequency").cast("long"))


def price_mention_overlay(bars_min: DataFrame, series_min: DataFrame, ticker: str | None = None,
                          bars_tz: str = "America/Los_Angeles") -> DataFrame:
    """OHLC and mention count of a ticker on one epoch-ms axis (SRV-5, JOI-6, DAT-11).
    Bars are keyed by wall clock in ``bars_tz``, mentions by UTC."""
    b, s = bars_min, series_min
    if ticker is not None:
        b, s = b.where(F.col("ticker") == ticker), s.where(F.col("ticker") == ticker)
    none = F.lit(None).cast("double")
    left = bars_on_axis(b, bars_tz).withColumn("frequency", F.lit(None).cast("long"))
    right = mentions_on_axis(s).select("ticker", "epoch_ms", *[none.alias(c) for c in PRICES], "frequency")
    # Each side has a key once at most, so one grouping of both is the full
    # outer join, with one exchange for it instead of two.
    merged = left.unionByName(right).groupBy("ticker", "epoch_ms").agg(*[F.max(c).alias(c) for c in (*PRICES, "frequency")])
    return merged.orderBy("ticker", "epoch_ms")


def stored_overlay(bars_axis: DataFrame, mentions_axis: DataFrame, ticker: str | None = None) -> DataFrame:
    """``price_mention_overlay`` of two stored tables that ``write_colocated``
    bucketed alike: a full outer join without an exchange. Rows of a ticker
    come in time order within a bucket; for one ``ticker``, whose filter
    reaches both scans, they are sorted."""
    if ticker is None:
        return bars_axis.join(mentions_axis, ["ticker", "epoch_ms"], "full_outer")
    b, s = (t.where(F.col("ticker") == ticker) for t in (bars_axis, mentions_axis))
    return b.join(s, ["ticker", "epoch_ms"], "full_outer").orderBy("epoch_ms")


def _bucket(ts, unit: str, n: int):
    unit = unit.lower().rstrip("s")
    if unit in ("minute", "hour", "day"):
        step = {"minute": n, "hour": 60 * n, "day": 1440 * n}[unit]
        if unit != "day" and (1440 % step):
            raise ValueError("n must divide a day")
        mins = F.timestamp_diff("MINUTE", _epoch_ntz(), ts)
        return F.timestamp_add("MINUTE", F.floor(mins / step) * step, _epoch_ntz())
    if unit == "week":
        if n != 1:
            raise ValueError("week grouping supports n=1")
        d = F.date_sub(F.to_date(ts), (F.dayofweek(ts) + 5) % 7)
        return F.make_timestamp_ntz(F.year(d), F.month(d), F.dayofmonth(d), F.lit(0), F.lit(0), F.lit(0))
    if unit == "month":
        if 12 % n:
            raise ValueError("n must divide 12")
        m0 = F.floor((F.month(ts) - 1) / n) * n + 1
        return F.make_timestamp_ntz(F.year(ts), m0, F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    raise ValueError(f"unknown unit {unit!r}")


def downsample(series: DataFrame, grain: str, unit: str, n: int) -> DataFrame:
    """Regroup a series to n units (minutes, hours, days, weeks, months),
    summing frequency and sentiment (AGG-13). Partial aggregation before the
    shuffle; a coarser bucket never regroups raw posts."""
    ts = parts_to_timestamp(grain)
    b = _bucket(ts, unit, n)
    return (series.select("ticker", local_to_epoch_millis(b, "UTC").alias("bucket_ms"), *SERIES_VALUES)
            .groupBy("ticker", "bucket_ms")
            .agg(F.sum("frequency").alias("frequency"), F.sum("sentiment").alias("sentiment")))


def lookback(series: DataFrame, grain: str, interval: str | None, display_hours: int = -5) -> DataFrame:
    """Rows within ``interval`` of the newest bucket, all rows for None
    (FLT-10), with the fixed display offset applied to a label (DAT-15). The
    newest bucket is a scalar subquery over the series, so give it the stored
    series table rather than the raw feed, which it would scan twice."""
    with_ts = series.withColumn("_ts", parts_to_timestamp(grain))
    if interval is not None:
        newest = with_ts.select(F.max("_ts")).scalar()
        with_ts = with_ts.where(F.col("_ts") > newest - F.expr(f"INTERVAL {interval}"))
    return with_ts.select("ticker", local_to_epoch_millis(F.col("_ts"), "UTC").alias("bucket_ms"),
                          F.substring(format_local_time(display_shift(F.col("_ts"), display_hours)), 1, 16).alias("display"),
                          *SERIES_VALUES)


def merge_views(batch: DataFrame, speed: DataFrame, grain: str, cutoff, mode: str = "cutoff") -> DataFrame:
    """Batch view ∪ real-time view of one series (SET-5, MTH-4).

    ``cutoff``: batch rows before the cutoff bucket, speed rows from it on.
    ``replace``: every key takes the speed row when present (keyed upsert).
    ``add``: full outer join on the key, missing sides count as 0."""
    keys = list(grain_columns(grain)) + ["ticker"]
    cols = keys + list(SERIES_VALUES)
    if mode == "cutoff":
        ts = parts_to_timestamp(grain)
        c = F.lit(cutoff).cast("timestamp_ntz") if isinstance(cutoff, str) else F.lit(cutoff)
        return batch.where(ts < c).select(*cols).unionByName(speed.where(ts >= c).select(*cols))
    if mode == "replace":
        u = (batch.select(*cols).withColumn("_v", F.lit(0))
             .unionByName(speed.select(*cols).withColumn("_v", F.lit(1))))
        return latest_per_key(u, keys, "_v").drop("_v")
    if mode == "add":
        j = batch.select(*cols).alias("b").join(speed.select(*cols).alias("s"), keys, "full_outer")
        return j.select(*keys, *[(F.coalesce(F.col("b." + v), F.lit(0)) + F.coalesce(F.col("s." + v), F.lit(0)))
                                 .alias(v) for v in SERIES_VALUES])
    raise ValueError("mode must be cutoff, replace or add")


__all__ = ["with_position", "live_panel", "recent_posts", "trending_at", "trending_by_local_hour", "mention_chart",
           "bars_on_axis", "mentions_on_axis", "price_mention_overlay", "stored_overlay", "downsample", "lookback", "merge_views", "parts_label"]
