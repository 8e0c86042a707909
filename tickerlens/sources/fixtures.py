"""Adapters from the driver's tables to the feeds this library consumes.

The driver's text tables carry no cashtags, so posts, trades, dumps, the
ticker universe and message batches are derived from ``events`` by fixed
rules (FIXTURES.md §3). Every adapter is a narrow projection of ``events``:
no shuffle, and it grows with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerlens.functions.timefn import format_local_time, format_post_time
from tickerlens.schemas import POST, TRADE_DUMP_HEADER

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# ---- fixed values: fixture rules --------------------------------------------
PHRASES = {  # event_type -> post phrase
    "purchase": "Buying",
    "error": "sell short",
    "view": "good GOOD",
    "signup": "chart",
    "click": "down_trend",
}
REPEAT_EVERY = 7          # every 7th event repeats its ticker and names the hot one
HOT_TICKER = "ZZZ"
DESCRIPTION = "fixture account"
TRADE_CONSTANTS = ("Auto trade", "OSE", "", "", "")  # board, source, buyer, seller, initiator
UNIVERSE_LISTS = ("A", "B")   # A: even user_id, B: user_id divisible by 3
MESSAGES_PER_FETCH = 30       # one fetch returns at most this many posts
FAILED_FETCH_EVERY = 11       # fetch groups with fetch % 11 == 5 answer status 429
FAILED_FETCH_AT = 5
SPREAD_DAYS = 731         # two years, one of them a leap year
# ------------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def events_over_years(ev: DataFrame) -> DataFrame:
    """``events`` shifted by 0..730 days by id, so that they meet every month,
    two year ends and the clock changes of two years."""
    days = (F.col("event_id") % SPREAD_DAYS).cast("int")
    return ev.withColumn("ts", F.timestamp_add("DAY", days, F.col("ts")))


def trades_with_ties(ev: DataFrame) -> DataFrame:
    """Trades of ``events_over_years`` at whole hours, all with one ingest
    stamp, every tenth without a price: open and close meet ties."""
    t = trades_from_events(events_over_years(ev))
    hour = F.timestamp_add("HOUR", F.timestamp_diff("HOUR", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col("time")),
                           F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))
    return t.select("ticker", hour.alias("time"), F.when(F.col("seq") % 10 != 0, F.col("price")).alias("price"),
                    "quantity", F.lit(0).cast("long").alias("seq"))


def broken_trade_lines(ev: DataFrame) -> DataFrame:
    """Trade lines of which some are short, and some have a number or a time
    that does not parse."""
    t = trades_from_events(ev)
    time, price = format_local_time(F.col("time")), F.col("price").cast("string")
    which = F.col("seq") % 20
    line = (F.when(which == 0, F.lit("garbage"))
            .when(which == 1, F.concat_ws(",", F.lit("1.0"), "ticker", time, price, F.lit("1")))
            .when(which == 2, F.concat_ws(",", F.lit("1.0"), "ticker", time, F.lit("many,1,b,s,,,")))
            .when(which == 3, F.concat_ws(",", F.lit("1.0"), "ticker", F.lit("noon"), price, F.lit("1,b,s,,,")))
            .when(which == 4, F.lit(""))
            .otherwise(F.concat_ws(",", F.lit("1.0"), "ticker", time, price, F.lit("1,b,s,,,"))))
    return t.select(line.alias("value"))


def broken_post_lines(ev: DataFrame) -> DataFrame:
    """Post lines of which some are no JSON, some have no text or no time that
    parses, and some are blank."""
    p = posts_from_events(ev)
    which = F.col("id") % 20
    time = F.when(which == 2, "noon").when(which != 3, F.col("created_at"))
    whole = F.to_json(F.struct("id", time.alias("created_at"), F.when(which != 1, F.col("text")).alias("text"), "user"))
    line = (F.when(which == 0, F.concat(F.lit('{"id": '), "id", F.lit(', "text": ')))
            .when(which == 4, F.lit(" ")).otherwise(whole))
    return p.select("id", line.alias("value"))


def dump_folder(ev: DataFrame, path: str) -> str:
    """A vendor's whole dump with times of full hours, as files in the order of
    arrival in a folder for each ticker."""
    t = trades_from_events(ev)
    hour = F.concat(F.substring(format_local_time(F.col("time"), "", "T", ""), 1, 11), F.lit("0000"))
    line = F.concat_ws(",", hour, F.col("price").cast("string"), F.col("quantity").cast("string"),
                       *[F.lit(c) for c in TRADE_CONSTANTS])
    (t.select("ticker", "seq", line.alias("value")).repartition("ticker").sortWithinPartitions("ticker", "seq")
     .drop("seq").write.partitionBy("ticker").text(path))
    return path


def bare_message_arrays(posts: DataFrame) -> DataFrame:
    """What the producer publishes for each fetch: the array of messages alone."""
    return message_batches_from_posts(posts).select(F.get_json_object("value", "$.messages").alias("value"))


def ticker_of(user_id: Column) -> Column:
    """Three capital letters from an id (0 -> AAA, 1 -> AAB, ...)."""
    u = user_id.cast("long")
    letter = lambda x: F.char((F.lit(65) + x % 26).cast("long"))
    return F.concat(letter(F.floor(u / 676)), letter(F.floor(u / 26)), letter(u))


def k_of(props: Column) -> Column:
    return F.get_json_object(props, "$.k").cast("int")


def _phrase(event_type: Column) -> Column:
    c = None
    for et, phrase in PHRASES.items():
        c = (F.when(event_type == et, F.lit(phrase)) if c is None
             else c.when(event_type == et, F.lit(phrase)))
    return c.otherwise(F.lit(""))


def posts_from_events(ev: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """posts: id, created_at (feed format), text, user{...}, and ``keep`` of ``ev``."""
    tk = ticker_of(F.col("user_id"))
    extra = F.when(F.col("event_id") % REPEAT_EVERY == 0,
                   F.concat(F.lit(" $"), tk, F.lit(f"x ${HOT_TICKER}"))).otherwise(F.lit(""))
    text = F.concat(F.lit("$"), tk, F.lit(" "), _phrase(F.col("event_type")), extra)
    user = F.struct(
        F.floor(F.col("value") * 10).cast("int").alias("followers_count"),
        k_of(F.col("props")).alias("friends_count"),
        F.lit(DESCRIPTION).alias("description"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("name"),
    )
    return ev.select(F.col("event_id").alias("id"), format_post_time(F.col("ts")).alias("created_at"),
                     text.alias("text"), user.alias("user"), *keep)


def post_lines(posts: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The raw feed: one JSON document per line in ``value`` (SNK-8 shape),
    plus any ``keep`` columns carried alongside."""
    return posts.select(F.to_json(F.struct(*[F.col(f.name) for f in POST.fields])).alias("value"), *keep)


def trades_from_events(ev: DataFrame) -> DataFrame:
    """Typed trades: ticker, time (venue wall clock), price, quantity, seq."""
    return ev.select(ticker_of(F.col("user_id")).alias("ticker"), F.col("ts").alias("time"),
                     F.col("value").alias("price"), k_of(F.col("props")).cast("double").alias("quantity"),
                     F.col("event_id").alias("seq"))


def trade_lines_from_events(ev: DataFrame, ingest_epoch: float = 1704067200.0) -> DataFrame:
    """Trade lines as the producer publishes them (10 comma fields), each
    followed by an empty line as the landing adds one (quirk Q15)."""
    t = trades_from_events(ev)
    fields = [F.format_string("%.1f", F.lit(float(ingest_epoch)) + F.col("seq")), F.col("ticker"),
              format_local_time(F.col("time")), F.col("price").cast("string"),
              F.col("quantity").cast("string")] + [F.lit(c) for c in TRADE_CONSTANTS]
    line = F.concat_ws(",", *fields)
    return t.select(F.explode(F.array(line, F.lit(""))).alias("value"))


def trade_dump_lines(ev: DataFrame, snapshot: str = "new") -> DataFrame:
    """Vendor dump lines per ticker (header + ``time,price,quantity,...``).

    ``new`` holds every event; ``old`` (the previous fetch) holds those with
    ``event_id % 3 <> 0``. Both carry the header line once per ticker.
    """
    t = trades_from_events(ev)
    if snapshot == "old":
        t = t.where(F.col("seq") % 3 != 0)
    elif snapshot != "new":
        raise ValueError("snapshot must be 'new' or 'old'")
    compact = format_local_time(F.col("time"), "", "T", "")
    body = F.concat_ws(",", compact, F.col("price").cast("string"),
                       F.col("quantity").cast("string"), *[F.lit(c) for c in TRADE_CONSTANTS])
    lines = t.select("ticker", body.alias("line"))
    headers = t.select("ticker").distinct().select("ticker", F.lit(TRADE_DUMP_HEADER).alias("line"))
    return lines.unionByName(headers)


def universe_from_events(ev: DataFrame) -> DataFrame:
    """Ticker lists: list, Ticker, Code, Name (lists overlap)."""
    u = ev.select("user_id").distinct()
    tk = ticker_of(F.col("user_id"))
    a = u.where(F.col("user_id") % 2 == 0).select(F.lit("A").alias("list"), tk.alias("Ticker"))
    b = u.where(F.col("user_id") % 3 == 0).select(F.lit("B").alias("list"), tk.alias("Ticker"))
    return a.unionByName(b).select("list", "Ticker", F.concat(F.lit("GOOG/NYSE_"), F.col("Ticker")).alias("Code"),
                                   F.concat(F.lit("Company "), F.col("Ticker")).alias("Name"))


def message_batches_from_posts(posts: DataFrame) -> DataFrame:
    """Per-symbol fetch responses: one JSON record with a status and an array of
    at most ``MESSAGES_PER_FETCH`` posts. Groups are keyed by (ticker,
    id div 30), so no group can grow with the data."""
    tk = F.regexp_extract(F.col("text"), r"^\$([A-Z]+)", 1)
    grouped = (posts.withColumn("symbol", tk)
               .groupBy("symbol", F.floor(F.col("id") / MESSAGES_PER_FETCH).alias("fetch"))
               .agg(F.collect_list(F.struct("id", "created_at", "text", "user")).alias("messages")))
    status = F.when(F.col("fetch") % FAILED_FETCH_EVERY == FAILED_FETCH_AT, F.lit(429)).otherwise(F.lit(200))
    return grouped.select("symbol", "fetch", F.to_json(F.struct(F.struct(status.alias("status")).alias("response"),
                                                                 F.col("messages"))).alias("value"))


def backup_bars_from_trades(trades: DataFrame, venue_tz: str = "Europe/Oslo") -> DataFrame:
    """Second vendor's minute bars: ticker, epoch (UTC minute), close, high, low,
    open, volume — volume counts trades instead of summing quantity."""
    utc = F.convert_timezone(F.lit(venue_tz), F.lit("UTC"), F.col("time"))
    minute = F.timestamp_diff("MINUTE", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), utc) * 60
    ordk = F.struct("time", "seq")
    return (trades.groupBy("ticker", minute.alias("epoch"))
            .agg(F.max_by("price", ordk).alias("close"), F.max("price").alias("high"),
                 F.min("price").alias("low"), F.min_by("price", ordk).alias("open"),
                 F.count(F.lit(1)).cast("double").alias("volume")))


def stage_files(df: DataFrame, path: str, n_files: int, order_col: str, ordered: bool = False) -> str:
    """Write ``df`` (one string column ``value`` plus ``order_col``) as about
    ``n_files`` text files in ``order_col`` order.

    ``ordered=True`` writes one slice per job so modification times follow
    the order, which a file stream with a watermark needs; slice bounds come
    from exact quantiles (a handful of scalars on the driver)."""
    if not ordered:
        # Hash placement is deterministic on retry and needs no sampling pass.
        (df.repartition(n_files, order_col).sortWithinPartitions(order_col)
         .select("value").write.mode("overwrite").text(path))
        return path
    probs = [i / n_files for i in range(1, n_files)]
    bounds = df.approxQuantile(order_col, probs, 0.0) if probs else []
    edges = [None] + bounds + [None]
    for i in range(n_files):
        lo, hi = edges[i], edges[i + 1]
        part = df
        if lo is not None:
            part = part.where(F.col(order_col) > lo)
        if hi is not None:
            part = part.where(F.col(order_col) <= hi)
        part.coalesce(1).sortWithinPartitions(order_col).select("value").write.mode("append").text(path)
    return path
