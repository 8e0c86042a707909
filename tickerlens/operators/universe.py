"""Ticker universes and the track filter (SRC-6, SET-3, AGG-10, AGG-11, FLT-9, JOI-5).

No operator here depends on the size of a universe: joins are plain, and AQE
decides by measured bytes whether a side is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerlens.functions.text import cashtags


def ticker_universe(universe: DataFrame, names) -> DataFrame:
    """Distinct ``$TICKER`` of the union of the named lists (SET-3, AGG-10).
    An unknown list name raises, as the reference's loader does; the check
    brings back one row for each requested name at most."""
    names = [names] if isinstance(names, str) else list(names)
    chosen = universe.where(F.col("list").isin(*names))
    known = {r[0] for r in chosen.select("list").distinct().collect()}
    missing = [n for n in names if n not in known]
    if missing:
        raise ValueError(f"unknown ticker list(s): {missing}")
    return chosen.select(F.concat(F.lit("$"), F.trim(F.col("Ticker"))).alias("cashtag")).distinct()


def track_list(tags: DataFrame, chunks: int = 1) -> DataFrame:
    """Comma-joined sorted ``$A,$B,...`` of a universe (AGG-11).

    One list is what a track filter takes; ``chunks`` deals a universe that is
    too large for one string over several lists by hash."""
    joined = F.concat_ws(",", F.array_sort(F.collect_list("cashtag"))).alias("track")
    if chunks == 1:
        return tags.agg(joined)
    return tags.groupBy(F.pmod(F.xxhash64("cashtag"), F.lit(chunks)).alias("chunk")).agg(joined)


#: Bits of one bitmap of ``bitmap_construct_agg``.
BITMAP_BITS = 32_768
#: Bitmaps of a sketch: one MiB whatever the size of the universe. A million
#: symbols set an eighth of its bits; more of them only make it prune less.
BITMAPS = 256


def _bit(cashtag) -> Column:
    return F.pmod(F.xxhash64(cashtag), F.lit(BITMAPS * BITMAP_BITS))


def symbol_sketch(tags: DataFrame) -> DataFrame:
    """One row, ``sketch``: the array of bitmaps in which the hash of each
    cashtag is set, null where a bitmap has none."""
    bits = tags.select(_bit("cashtag").alias("bit"))
    maps = (bits.groupBy(F.floor(F.col("bit") / BITMAP_BITS).cast("int").alias("k"))
            .agg(F.bitmap_construct_agg(F.col("bit") % BITMAP_BITS).alias("v")))
    found = maps.agg(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("found"))
    return found.select(F.transform(F.sequence(F.lit(0), F.lit(BITMAPS - 1)), lambda k: F.col("found")[k]).alias("sketch"))


def _may_hold(sketch: Column, cashtag: Column) -> Column:
    """True for every cashtag of the sketch, and for few others."""
    bit = _bit(cashtag)
    place = bit % BITMAP_BITS
    byte = F.substr(F.get(sketch, F.floor(bit / BITMAP_BITS).cast("int")), (F.floor(place / 8) + 1).cast("int"), F.lit(1))
    return F.coalesce(F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (place % 8).cast("int")) == 1, F.lit(False))


def posts_in_universe(posts: DataFrame, tags: DataFrame) -> DataFrame:
    """Posts naming at least one cashtag of the universe, whole rows (FLT-9).

    A sketch of the universe, a scalar, first leaves out the posts none of whose
    cashtags can match, row by row. Of the others only the distinct sets of
    cashtags that may match are looked up in the universe; a post stays if its
    set does, which takes whole posts through one exchange at most (none where
    the sets are few enough for AQE to broadcast). Rows need no id, equal rows
    all stay, a post without text or cashtags goes."""
    sketched = posts.select(F.struct(*[F.col(c) for c in posts.columns]).alias("post"),
                            F.array_distinct(cashtags(F.col("text"))).alias("named"),
                            symbol_sketch(tags).scalar().alias("sketch"))
    likely = (sketched.select("post", F.array_sort(F.filter("named", lambda c: _may_hold(F.col("sketch"), c))).alias("likely"))
              .where(F.size("likely") > 0))
    sets = likely.select("likely").distinct()
    hits = (sets.select("likely", F.explode("likely").alias("cashtag"))
            .join(tags.select("cashtag"), "cashtag", "left_semi").select("likely"))
    return likely.join(hits, "likely", "left_semi").select("post.*")


def trades_by_exchange(universe: DataFrame, trades: DataFrame, exchanges: dict[str, str]) -> DataFrame:
    """Trades joined to the exchange of their ticker's list (JOI-5).

    ``exchanges`` maps list name -> exchange code; a ticker in several lists
    keeps the smallest code so every trade appears once."""
    m = None
    for name, code in exchanges.items():
        m = F.when(F.col("list") == name, F.lit(code)) if m is None else m.when(F.col("list") == name, F.lit(code))
    u = (universe.where(F.col("list").isin(*exchanges.keys()))
         .select(F.trim("Ticker").alias("ticker"), m.alias("exchange"))
         .groupBy("ticker").agg(F.min("exchange").alias("exchange")))
    return trades.join(u, "ticker", "inner")
