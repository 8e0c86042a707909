"""Open/high/low/close/volume bars (JOB-3) and backfill (JOB-9).

One scan, one hash aggregate: max, min, min_by, max_by and sum all have
partial (map-side) forms, so the bar of a hot ticker is combined before the
shuffle. Open and close are the prices of the first and last priced trade by
UTC instant, then sequence, then price and quantity: a total order on what
distinguishes trades, so bars don't depend on the order of the input, and the
repeated hour of an autumn fold is in its true order. Trades without a time
belong to no bucket and are left out, as the inner joins of the reference do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerlens.functions.timefn import convert_zone, epoch_to_local, grain_columns, grain_parts
from tickerlens.operators.keyed import latest_per_key

BAR_VALUES = ("high", "low", "open", "close", "volume")
MINUTE_KEYS = ("ticker", "year", "month", "day", "hour", "minute")


def _local(trades: DataFrame, from_tz: str, to_tz: str, grain: str) -> DataFrame:
    """ticker, parts in ``to_tz``, price, quantity and the order key ``ord``,
    null for trades without a price (which ``min_by`` and ``max_by`` skip)."""
    timed = trades.select("ticker", convert_zone(F.col("time"), from_tz, to_tz).alias("local"),
                          convert_zone(F.col("time"), from_tz, "UTC").alias("utc"), "price", "quantity", "seq")
    order = F.when(F.col("price").isNotNull(), F.struct("utc", "seq", "price", "quantity"))
    return (timed.where(F.col("local").isNotNull())
            .select("ticker", *grain_parts(F.col("local"), grain), "price", "quantity", order.alias("ord")))


def price_bars(trades: DataFrame, grain: str, from_tz: str = "Europe/Oslo",
               to_tz: str = "America/Los_Angeles") -> DataFrame:
    """ticker, parts, high, low, open, close, volume per (ticker, bucket in ``to_tz``)."""
    parts = list(grain_columns(grain))
    return (_local(trades, from_tz, to_tz, grain).groupBy("ticker", *parts)
            .agg(F.max("price").alias("high"), F.min("price").alias("low"),
                 F.min_by("price", "ord").alias("open"), F.max_by("price", "ord").alias("close"),
                 F.sum("quantity").alias("volume")))


def price_bars_join_form(trades: DataFrame, grain: str, from_tz: str = "Europe/Oslo",
                         to_tz: str = "America/Los_Angeles") -> DataFrame:
    """The five aggregates computed separately and inner-joined on
    (ticker, bucket), as the reference does (JOI-2). Kept for parity only;
    ``price_bars`` is the one-shuffle plan."""
    parts = list(grain_columns(grain))
    keys = ["ticker"] + parts
    t = _local(trades, from_tz, to_tz, grain)
    hi = t.groupBy(*keys).agg(F.max("price").alias("high"))
    lo = t.groupBy(*keys).agg(F.min("price").alias("low"))
    op = t.groupBy(*keys).agg(F.min_by("price", "ord").alias("open"))
    cl = t.groupBy(*keys).agg(F.max_by("price", "ord").alias("close"))
    vo = t.groupBy(*keys).agg(F.sum("quantity").alias("volume"))
    return hi.join(lo, keys).join(op, keys).join(cl, keys).join(vo, keys)


def backup_to_minute_bars(backup: DataFrame, tz: str = "America/Los_Angeles", day: int | None = None,
                          ticker: str | None = None) -> DataFrame:
    """Backup rows (epoch, close, high, low, open, volume) -> minute-bar rows in
    ``tz`` (SRC-5, DAT-9); ``day`` keeps one day of month (FLT-8); ``ticker``
    names the symbol of a single-symbol file (PRJ-6)."""
    b = backup
    if "ticker" not in b.columns:
        if ticker is None:
            raise ValueError("backup rows carry no ticker; pass ticker=")
        b = b.withColumn("ticker", F.lit(ticker))
    elif ticker is not None:
        b = b.where(F.col("ticker") == ticker)
    local = epoch_to_local(F.col("epoch"), tz)
    out = b.select("ticker", *grain_parts(local, "MIN"), *[F.col(c).cast("double") for c in BAR_VALUES],
                   F.col("epoch").cast("long").alias("epoch"))
    if day is not None:
        out = out.where(F.col("day") == day)
    return out


def backfill_bars(bars: DataFrame, backup: DataFrame, day: int, tz: str = "America/Los_Angeles",
                  ticker: str | None = None) -> DataFrame:
    """Minute bars with the backup rows of one day inserted; on an equal key
    the backup row replaces the primary one, as an insert into a keyed table
    would (JOB-9, SET-4, WIN-5, SNK-13)."""
    add = backup_to_minute_bars(backup, tz, day, ticker)
    cols = list(MINUTE_KEYS) + list(BAR_VALUES)
    # Version: primary rows 0, backup rows their epoch, so a backup row wins
    # and, where two backup minutes share a local minute (autumn fold), the
    # later one wins, as sequential inserts would.
    merged = (bars.select(*cols).withColumn("_v", F.lit(0).cast("long"))
              .unionByName(add.select(*cols, F.col("epoch").alias("_v"))))
    return latest_per_key(merged, list(MINUTE_KEYS), "_v").drop("_v")
