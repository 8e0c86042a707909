"""Named queries over the driver's tables, each with its oracle SQL.

``QUERIES[name] = (callable(spark, sf_dir) -> DataFrame, oracle_sql or None)``.
Every query reads whole tables; a query without oracle SQL is checked in
pytest against a brute-force computation instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tickerlens.operators import bars as B
from tickerlens.operators import keyed as K
from tickerlens.operators import mentions as M
from tickerlens.plans import sql as S
from tickerlens.sources import fixtures as FX

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, tuple[QueryFn, str | None]] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = (fn, oracle)
        return fn
    return deco


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FX.posts_from_events(FX.events(spark, sf_dir))


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FX.trades_from_events(FX.events(spark, sf_dir))


_GRAIN_SUFFIX = {"YEAR": "year", "MONTH": "month", "WEEK": "week", "DAY": "day",
                 "HR": "hr", "MIN": "min", "SEC": "sec"}

# ---- JOB-1: mention and sentiment series, all grains ------------------------
for _g, _sfx in _GRAIN_SUFFIX.items():
    register(
        f"mention_series_{_sfx}",
        S.with_base(f"""
SELECT {S.part_select(_g, 'pts')}, ticker, count(*) AS frequency, CAST(sum(score) AS BIGINT) AS sentiment
FROM occ GROUP BY ALL"""),
    )((lambda g: lambda spark, d: M.mention_series(posts(spark, d), g))(_g))

register("mention_series_join_form", S.with_base(f"""
SELECT {S.part_select('HR', 'pts')}, ticker, count(*) AS frequency, CAST(sum(score) AS BIGINT) AS sentiment
FROM occ GROUP BY ALL"""))(lambda spark, d: M.mention_series_join_form(posts(spark, d), "HR"))

# ---- JOB-2 / JOB-6: top trending ------------------------------------------------
def _rank_sql(grain: str, k: int | None = None, distinct: bool = False) -> str:
    names = S.part_names(grain)
    src = "series"
    dedup = ""
    if distinct:
        dedup = f""",
dedup AS (
  SELECT * FROM series
  QUALIFY row_number() OVER (PARTITION BY {names}, frequency ORDER BY ticker) = 1)"""
        src = "dedup"
    where = f" WHERE rank <= {k}" if k is not None else ""
    return S.with_base(f"""
series AS (
  SELECT {S.part_select(grain, 'pts')}, ticker, count(*) AS frequency, CAST(sum(score) AS BIGINT) AS sentiment
  FROM occ GROUP BY ALL){dedup}
SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY {names} ORDER BY frequency DESC, ticker) AS BIGINT) AS rank
  FROM {src}){where}""")


for _g, _sfx in _GRAIN_SUFFIX.items():
    if _g in ("MIN", "SEC"):
        continue
    register(f"top_trending_{_sfx}", _rank_sql(_g))((lambda g: lambda spark, d: M.trending(posts(spark, d), g))(_g))

register("top5_per_hour", _rank_sql("HR", 5))(lambda spark, d: M.trending(posts(spark, d), "HR", k=5))
register("top10_per_day", _rank_sql("DAY", 10))(lambda spark, d: M.trending(posts(spark, d), "DAY", k=10))
register("trending_distinct_frequency", _rank_sql("DAY", 10, distinct=True))(
    lambda spark, d: M.trending(posts(spark, d), "DAY", k=10, distinct_frequency=True))


# ---- JOB-7: most positive / negative post mentions per bucket --------------------
def _extreme_sql(grain: str, k: int, positive: bool) -> str:
    order = "score DESC" if positive else "score ASC"
    names = S.part_names(grain)
    return S.with_base(f"""
p AS (SELECT {S.part_select(grain, 'pts')}, ticker, score, text FROM occ),
ranked AS (
  SELECT {names}, ticker, score AS sentiment,
         CAST(row_number() OVER (PARTITION BY {names} ORDER BY {order}, ticker, text) AS BIGINT) AS rank
  FROM p)
SELECT * FROM ranked WHERE rank <= {k}""")


register("sentiment_top5_positive", _extreme_sql("DAY", 5, True))(
    lambda spark, d: M.sentiment_extremes(posts(spark, d), "DAY", 5, positive=True))
register("sentiment_top5_negative", _extreme_sql("DAY", 5, False))(
    lambda spark, d: M.sentiment_extremes(posts(spark, d), "DAY", 5, positive=False))

# ---- SRT-7 / SRT-8: global top tickers ----------------------------------------------
register("global_top10_tickers", S.with_base("""
agg AS (SELECT ticker, count(*) AS frequency FROM occ GROUP BY ticker)
SELECT ticker, frequency AS value FROM agg ORDER BY frequency DESC, ticker LIMIT 10"""))(
    lambda spark, d: M.global_top(posts(spark, d), "frequency", 10))
register("global_top10_positive", S.with_base("""
agg AS (SELECT ticker, CAST(sum(score) AS BIGINT) AS sentiment FROM occ GROUP BY ticker)
SELECT ticker, sentiment AS value FROM agg ORDER BY sentiment DESC, ticker LIMIT 10"""))(
    lambda spark, d: M.global_top(posts(spark, d), "sentiment", 10))
register("global_top10_negative", S.with_base("""
agg AS (SELECT ticker, CAST(sum(score) AS BIGINT) AS sentiment FROM occ GROUP BY ticker)
SELECT ticker, sentiment AS value FROM agg ORDER BY sentiment ASC, ticker LIMIT 10"""))(
    lambda spark, d: M.global_top(posts(spark, d), "sentiment", 10, ascending=True))

register("author_importance", S.with_base("""
SELECT id, followers, friends,
       CASE WHEN friends > 10 THEN CAST(followers AS DOUBLE) / CAST(friends AS DOUBLE) ELSE 1.0 END AS importance
FROM posts"""))(lambda spark, d: M.author_importance(posts(spark, d)))

# ---- JOB-3: price bars, all grains ----------------------------------------------------
for _g, _sfx in _GRAIN_SUFFIX.items():
    register(
        f"bars_{_sfx}",
        S.with_base(f"""
SELECT ticker, {S.part_select(_g, 'lt')}, max(price) AS high, min(price) AS low,
       arg_min(price, {{'t': lt, 's': seq}}) AS open, arg_max(price, {{'t': lt, 's': seq}}) AS close,
       sum(quantity) AS volume
FROM trades GROUP BY ALL"""),
    )((lambda g: lambda spark, d: B.price_bars(trades(spark, d), g))(_g))

register("bars_join_form", S.with_base(f"""
SELECT ticker, {S.part_select('HR', 'lt')}, max(price) AS high, min(price) AS low,
       arg_min(price, {{'t': lt, 's': seq}}) AS open, arg_max(price, {{'t': lt, 's': seq}}) AS close,
       sum(quantity) AS volume
FROM trades GROUP BY ALL"""))(lambda spark, d: B.price_bars_join_form(trades(spark, d), "HR"))

# ---- ingest: raw feeds, dumps, universes, message batches ---------------------------
from pyspark.sql import functions as F  # noqa: E402

from tickerlens.functions import timefn as TF  # noqa: E402
from tickerlens.operators import universe as U  # noqa: E402
from tickerlens.sources import readers as R  # noqa: E402

INGEST_EPOCH = 1704067200.0


def _trades_from_csv(spark, d):
    lines = FX.trade_lines_from_events(FX.events(spark, d), INGEST_EPOCH)
    t = R.parse_trade_lines(lines)
    return t.select("ingest_epoch", "ticker", TF.format_local_time(F.col("time")).alias("time"),
                    "price", "quantity", "board", "source", "buyer", "seller", "initiator")


register("trades_from_csv", S.with_base(f"""
x AS (SELECT 1)
SELECT CAST({INGEST_EPOCH} + seq AS DOUBLE) AS ingest_epoch, ticker, strftime(time, '%Y-%m-%d %H:%M:%S') AS time,
       price, quantity, 'Auto trade' AS board, 'OSE' AS source, '' AS buyer, '' AS seller, '' AS initiator
FROM trades"""))(_trades_from_csv)


def _post_times(spark, d):
    p = M.post_times(posts(spark, d))
    return p.select("id", "created_at", *TF.grain_parts(F.col("ts"), "SEC"))


register("post_times", S.with_base("""
x AS (SELECT 1)
SELECT id, strftime(pts, '%a %b %d %H:%M:%S +0000 %Y') AS created_at,
       CAST(year(pts) AS INTEGER) AS year, CAST(month(pts) AS INTEGER) AS month, CAST(day(pts) AS INTEGER) AS day,
       CAST(hour(pts) AS INTEGER) AS hour, CAST(minute(pts) AS INTEGER) AS minute,
       CAST(floor(second(pts)) AS INTEGER) AS second
FROM posts"""))(_post_times)


def _week_labels(spark, d):
    p = M.post_times(posts(spark, d))
    iso = TF.grain_parts(F.col("ts"), "WEEK")
    cal = TF.grain_parts(F.col("ts"), "WEEK", week_year="calendar")
    return p.select("id", iso[0].alias("week_year"), iso[1].alias("week"),
                    F.concat_ws("-", cal[0], cal[1]).alias("calendar_label"))


register("week_labels", S.with_base("""
x AS (SELECT 1)
SELECT id, CAST(isoyear(pts) AS INTEGER) AS week_year, CAST(week(pts) AS INTEGER) AS week,
       CAST(year(pts) AS VARCHAR) || '-' || CAST(week(pts) AS VARCHAR) AS calendar_label
FROM posts"""))(_week_labels)

_DUMP_SQL = """
dump AS (
  SELECT ticker, seq, strftime(time, '%Y%m%dT%H%M%S') || ',' || CAST(price AS VARCHAR) || ',' ||
         CAST(quantity AS VARCHAR) || ',Auto trade,OSE,,,' AS line
  FROM trades),
diff AS (
  SELECT ticker, line FROM dump
  EXCEPT
  SELECT ticker, line FROM dump WHERE seq % 3 <> 0)"""

register("trade_dump_diff", S.with_base(_DUMP_SQL + "\nSELECT * FROM diff"))(
    lambda spark, d: R.trade_dump_diff(FX.trade_dump_lines(FX.events(spark, d), "new"),
                                       FX.trade_dump_lines(FX.events(spark, d), "old")))


def _dump_normalized(spark, d):
    ev = FX.events(spark, d)
    out = R.normalize_trade_dump(FX.trade_dump_lines(ev, "new"), FX.trade_dump_lines(ev, "old"), INGEST_EPOCH)
    return out.select("ticker", "time", "price", "quantity", "value")


register("trade_dump_normalized", S.with_base(_DUMP_SQL + f"""
, p AS (SELECT ticker, string_split(line, ',') AS f FROM diff)
SELECT ticker, strftime(strptime(f[1], '%Y%m%dT%H%M%S'), '%Y-%m-%d %H:%M:%S') AS time, f[2] AS price, f[3] AS quantity,
       '{INGEST_EPOCH:.1f}' || ',' || ticker || ',' || strftime(strptime(f[1], '%Y%m%dT%H%M%S'), '%Y-%m-%d %H:%M:%S')
       || ',' || array_to_string(f[2:8], ',') AS value
FROM p"""))(_dump_normalized)

_UNIVERSE_SQL = """
uids AS (SELECT DISTINCT user_id, tk FROM ev),
universe AS (
  SELECT 'A' AS list, tk AS Ticker FROM uids WHERE user_id % 2 = 0
  UNION ALL
  SELECT 'B' AS list, tk AS Ticker FROM uids WHERE user_id % 3 = 0)"""


def _universe(spark, d):
    return FX.universe_from_events(FX.events(spark, d))


register("universe_union", S.with_base(_UNIVERSE_SQL + """
SELECT DISTINCT '$' || Ticker AS cashtag FROM universe"""))(
    lambda spark, d: U.ticker_universe(_universe(spark, d), ["A", "B"]))

register("track_list", S.with_base(_UNIVERSE_SQL + """
, tags AS (SELECT DISTINCT '$' || Ticker AS cashtag FROM universe)
SELECT string_agg(cashtag, ',' ORDER BY cashtag) AS track FROM tags"""))(
    lambda spark, d: U.track_list(U.ticker_universe(_universe(spark, d), ["A", "B"])))

register("posts_in_universe", S.with_base(_UNIVERSE_SQL + """
, tags AS (SELECT DISTINCT '$' || Ticker AS cashtag FROM universe WHERE list = 'A')
SELECT id, text FROM posts
WHERE len(list_intersect(regexp_extract_all(text, '\\$[A-Z]+'), (SELECT list(cashtag) FROM tags))) > 0"""))(
    lambda spark, d: U.posts_in_universe(posts(spark, d), U.ticker_universe(_universe(spark, d), ["A"]))
    .select("id", "text"))

register("trades_by_exchange", S.with_base(_UNIVERSE_SQL + """
, ex AS (SELECT Ticker AS ticker, min(CASE list WHEN 'A' THEN 'O' ELSE 'N' END) AS exchange FROM universe GROUP BY 1)
SELECT t.ticker, e.exchange, t.seq, t.price FROM trades t JOIN ex e ON t.ticker = e.ticker"""))(
    lambda spark, d: U.trades_by_exchange(_universe(spark, d), trades(spark, d), {"A": "O", "B": "N"})
    .select("ticker", "exchange", "seq", "price"))


def _messages(spark, d):
    recs = FX.message_batches_from_posts(posts(spark, d))
    m = R.explode_message_batches(recs)
    return m.select("id", "created_at", "text", F.col("user.followers_count").alias("followers"),
                    F.col("user.friends_count").alias("friends"), F.col("user.name").alias("name"))


register("message_batches_exploded", S.with_base("""
x AS (SELECT 1)
SELECT id, strftime(pts, '%a %b %d %H:%M:%S +0000 %Y') AS created_at, text, followers, friends, uname AS name
FROM posts WHERE (id // 30) % 11 <> 5"""))(_messages)

register("posts_published", S.with_base("""
x AS (SELECT 1)
SELECT '{"id":' || id || ',"created_at":"' || strftime(pts, '%a %b %d %H:%M:%S +0000 %Y') || '","text":"' || text
       || '","user":{"followers_count":' || followers || ',"friends_count":' || friends
       || ',"description":"fixture account","name":"' || uname || '"}}' AS value
FROM posts"""))(lambda spark, d: R.publish_posts(posts(spark, d)))

register("floor_minutes_15", """
SELECT event_id, strftime(date_trunc('hour', ts) + INTERVAL (15 * (minute(ts) // 15)) MINUTE, '%Y%m%d%H%M%S') AS block,
       strftime(ts, '%Y-%m-%d') AS day_label
FROM events""")(
    lambda spark, d: FX.events(spark, d).select("event_id", TF.floor_minutes(F.col("ts"), 15).alias("block"),
                                                TF.floor_minutes(F.col("ts"), 0).alias("day_label")))

# ---- sliding windows, snapshots and serving views -------------------------------------
from tickerlens.operators import sliding as SL  # noqa: E402
from tickerlens.operators import views as V  # noqa: E402

_SLIDING_SQL = """
sl AS (
  SELECT ticker, (CAST(floor(epoch(pts) / 5) AS BIGINT) + 1 + r.i) * 5000 AS window_end_ms, score
  FROM occ, range(0, 120) AS r(i)),
counts AS (
  SELECT ticker, window_end_ms, count(*) AS frequency, CAST(sum(score) AS BIGINT) AS sentiment
  FROM sl GROUP BY ALL)"""

register("sliding_counts_pane", S.with_base(_SLIDING_SQL + "\nSELECT * FROM counts"))(
    lambda spark, d: SL.sliding_counts(posts(spark, d), form="pane"))
register("sliding_counts_plain", S.with_base(_SLIDING_SQL + "\nSELECT * FROM counts"))(
    lambda spark, d: SL.sliding_counts(posts(spark, d), form="plain"))

_TOP5_SQL = _SLIDING_SQL + """,
top5 AS (
  SELECT * FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY window_end_ms ORDER BY frequency DESC, ticker) - 1 AS BIGINT) AS id
    FROM counts) WHERE id < 5)"""

register("top5_per_window", S.with_base(_TOP5_SQL + "\nSELECT * FROM top5"))(
    lambda spark, d: SL.top_of_runs(SL.sliding_runs(posts(spark, d)), k=5))


def _snapshots(spark, d):
    t = SL.top_of_runs(SL.sliding_runs(posts(spark, d)), k=5)
    return t.select(F.col("window_end_ms").alias("timestamp"), "id", "ticker", "frequency", "sentiment")


register("live_panel", S.with_base(_TOP5_SQL + """
, newest AS (
  SELECT *, row_number() OVER (ORDER BY window_end_ms DESC, id) AS pos
  FROM (SELECT * FROM top5 ORDER BY window_end_ms DESC, id LIMIT 5))
SELECT CAST(row_number() OVER (ORDER BY frequency, pos) AS BIGINT) AS position, ticker, frequency,
       CASE WHEN sentiment > 0 THEN 'green' WHEN sentiment < 0 THEN 'red' ELSE 'blue' END AS colour
FROM newest"""))(lambda spark, d: V.live_panel(_snapshots(spark, d)))

_RECENT_SQL = """
newest AS (SELECT * FROM posts ORDER BY pts DESC, id DESC LIMIT 10)"""
register("recent_posts", S.with_base(_RECENT_SQL + """
SELECT id, uname AS user, text,
       year(pts) || '-' || month(pts) || '-' || day(pts) || ' ' || hour(pts) || ':' || minute(pts) || ':' ||
       CAST(floor(second(pts)) AS INTEGER) AS time
FROM newest"""))(lambda spark, d: V.recent_posts(posts(spark, d), 10))
register("recent_posts_text", S.with_base(_RECENT_SQL + "\nSELECT text FROM newest"))(
    lambda spark, d: V.recent_posts(posts(spark, d), 10).select("text"))

_HOURLY_SQL = f"""
hourly AS (
  SELECT {S.part_select('HR', 'pts')}, ticker, count(*) AS frequency, CAST(sum(score) AS BIGINT) AS sentiment
  FROM occ GROUP BY ALL)"""
_COLOUR = "CASE WHEN sentiment > 0 THEN 'green' WHEN sentiment < 0 THEN 'red' ELSE 'blue' END AS colour"

register("trending_at_eastern_hour", S.with_base(_HOURLY_SQL + f"""
SELECT ticker, frequency, {_COLOUR} FROM hourly
WHERE year = 2024 AND month = 1 AND day = 15 AND hour = 14
ORDER BY frequency DESC, ticker LIMIT 10"""))(
    lambda spark, d: V.trending_at(M.mention_series(posts(spark, d), "HR"), "2024_01_15_09", "America/New_York"))

register("trending_by_eastern_hour", S.with_base(_HOURLY_SQL + f"""
SELECT strftime(timezone('America/New_York', timezone('UTC', make_timestamp(year, month, day, hour, 0, 0))),
                '%Y_%m_%d_%H') AS local_hour, ticker, frequency, {_COLOUR}, rank
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY year, month, day, hour ORDER BY frequency DESC, ticker) AS BIGINT) AS rank
      FROM hourly) WHERE rank <= 10"""))(
    lambda spark, d: V.trending_by_local_hour(M.mention_series(posts(spark, d), "HR"), "America/New_York"))

_MINUTE_SQL = """
minute_series AS (
  SELECT ticker, date_trunc('minute', pts) AS m, count(*) AS frequency, CAST(sum(score) AS BIGINT) AS sentiment
  FROM occ GROUP BY ALL)"""

register("mention_chart", S.with_base(_MINUTE_SQL + """
SELECT ticker, epoch_ms(m) AS epoch_ms, frequency, CAST(sign(sentiment) AS INTEGER) AS sign FROM minute_series"""))(
    lambda spark, d: V.mention_chart(M.mention_series(posts(spark, d), "MIN")))
register("mention_chart_hot", S.with_base(_MINUTE_SQL + """
SELECT ticker, epoch_ms(m) AS epoch_ms, frequency, CAST(sign(sentiment) AS INTEGER) AS sign
FROM minute_series WHERE ticker = 'ZZZ'"""))(
    lambda spark, d: V.mention_chart(M.mention_series(posts(spark, d), "MIN"), "ZZZ"))

register("price_mention_overlay", S.with_base(_MINUTE_SQL + """
, bars AS (
  SELECT ticker, epoch_ms(timezone('America/Los_Angeles', date_trunc('minute', lt))) AS epoch_ms,
         arg_min(price, {'t': lt, 's': seq}) AS open, max(price) AS high, min(price) AS low,
         arg_max(price, {'t': lt, 's': seq}) AS close
  FROM trades GROUP BY ALL),
ms AS (SELECT ticker, epoch_ms(m) AS epoch_ms, frequency FROM minute_series)
SELECT coalesce(b.ticker, s.ticker) AS ticker, coalesce(b.epoch_ms, s.epoch_ms) AS epoch_ms,
       b.open, b.high, b.low, b.close, s.frequency
FROM bars b FULL OUTER JOIN ms s ON b.ticker = s.ticker AND b.epoch_ms = s.epoch_ms"""))(
    lambda spark, d: V.price_mention_overlay(B.price_bars(trades(spark, d), "MIN"),
                                             M.mention_series(posts(spark, d), "MIN")))


def _down_sql(bucket_expr: str) -> str:
    return S.with_base(_MINUTE_SQL + f"""
SELECT ticker, {bucket_expr} AS bucket_ms, CAST(sum(frequency) AS BIGINT) AS frequency,
       CAST(sum(sentiment) AS BIGINT) AS sentiment
FROM minute_series GROUP BY ALL""")


for _name, _unit, _n, _expr in (
        ("downsample_5min", "minute", 5, "CAST(floor(epoch(m) / 300) AS BIGINT) * 300000"),
        ("downsample_6h", "hour", 6, "CAST(floor(epoch(m) / 21600) AS BIGINT) * 21600000"),
        ("downsample_week", "week", 1, "epoch_ms(date_trunc('week', m))"),
        ("downsample_3month", "month", 3,
         "epoch_ms(make_timestamp(year(m), CAST(floor((month(m) - 1) / 3) * 3 + 1 AS BIGINT), 1, 0, 0, 0))")):
    register(_name, _down_sql(_expr))(
        (lambda u, n: lambda spark, d: V.downsample(M.mention_series(posts(spark, d), "MIN"), "MIN", u, n))(_unit, _n))

register("lookback_7d", S.with_base(_MINUTE_SQL + """
SELECT ticker, epoch_ms(m) AS bucket_ms, strftime(m - INTERVAL 5 HOUR, '%Y-%m-%d %H:%M') AS display, frequency, sentiment
FROM minute_series WHERE m > (SELECT max(m) FROM minute_series) - INTERVAL 7 DAY"""))(
    lambda spark, d: V.lookback(M.mention_series(posts(spark, d), "MIN"), "MIN", "7 DAYS"))


def _merged(spark, d):
    p = M.post_times(posts(spark, d))
    batch_posts = p.where(F.col("ts") < F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")).drop("ts")
    speed_posts = p.where(F.col("ts") >= F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")).drop("ts")
    return V.merge_views(M.mention_series(batch_posts, "HR"), M.mention_series(speed_posts, "HR"), "HR",
                         "2024-01-15 00:00:00")


register("merged_mention_view", S.with_base(_HOURLY_SQL + "\nSELECT * FROM hourly"))(_merged)


def _backfill(spark, d):
    t = trades(spark, d)
    return B.backfill_bars(B.price_bars(t, "MIN"), FX.backup_bars_from_trades(t), day=15)


register("backfill_minute_bars", S.with_base(f"""
bars AS (
  SELECT ticker, {S.part_select('MIN', 'lt')}, max(price) AS high, min(price) AS low,
         arg_min(price, {{'t': lt, 's': seq}}) AS open, arg_max(price, {{'t': lt, 's': seq}}) AS close,
         sum(quantity) AS volume
  FROM trades GROUP BY ALL),
backup AS (
  SELECT ticker, CAST(floor(epoch(timezone('Europe/Oslo', time)) / 60) AS BIGINT) * 60 AS epoch,
         arg_max(price, {{'t': time, 's': seq}}) AS close, max(price) AS high, min(price) AS low,
         arg_min(price, {{'t': time, 's': seq}}) AS open, CAST(count(*) AS DOUBLE) AS volume
  FROM trades GROUP BY ALL),
bl AS (SELECT *, timezone('America/Los_Angeles', to_timestamp(epoch)) AS loc FROM backup),
bk AS (
  SELECT ticker, {S.part_select('MIN', 'loc')}, high, low, open, close, volume
  FROM bl WHERE day(loc) = 15)
SELECT * FROM bk
UNION ALL
SELECT b.* FROM bars b ANTI JOIN bk USING (ticker, year, month, day, hour, minute)"""))(_backfill)

# ---- sinks: write, read back ---------------------------------------------------------------
from tickerlens.session import scratch_path, start_stream  # noqa: E402
from tickerlens.sinks import tables as SK  # noqa: E402
from tickerlens.streaming import landing as SLAND  # noqa: E402
from tickerlens.streaming import sources as SSRC  # noqa: E402
from tickerlens.streaming import totals as STOT  # noqa: E402
from tickerlens.streaming import trending as STRD  # noqa: E402


def _sink_roundtrip(spark, d):
    path = scratch_path(spark, "series_hr")
    SK.write_series(M.mention_series(posts(spark, d), "HR"), path, "HR")
    return spark.read.parquet(path).select("year", "month", "day", "hour", "ticker", "frequency", "sentiment")


register("sink_roundtrip", S.with_base(_HOURLY_SQL + "\nSELECT * FROM hourly"))(_sink_roundtrip)


def _bars_sink(spark, d):
    path = scratch_path(spark, "bars_min")
    SK.write_bars(B.price_bars(trades(spark, d), "MIN"), path, "MIN")
    return spark.read.parquet(path).select("ticker", "year", "month", "day", "hour", "minute",
                                           "high", "low", "open", "close", "volume")


register("bars_sink_roundtrip", S.with_base(f"""
x AS (SELECT 1)
SELECT ticker, {S.part_select('MIN', 'lt')}, max(price) AS high, min(price) AS low,
       arg_min(price, {{'t': lt, 's': seq}}) AS open, arg_max(price, {{'t': lt, 's': seq}}) AS close,
       sum(quantity) AS volume
FROM trades GROUP BY ALL"""))(_bars_sink)


def _trending_sink(spark, d):
    path = scratch_path(spark, "trending_day")
    SK.write_trending(M.trending(posts(spark, d), "DAY", k=10), path, "DAY")
    return spark.read.parquet(path).select("year", "month", "day", "ticker", "frequency", "sentiment", "rank")


register("trending_sink_roundtrip", _rank_sql("DAY", 10))(_trending_sink)


def _upsert_roundtrip(spark, d):
    p = M.post_times(posts(spark, d))
    early = p.where(F.col("ts") < F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")).drop("ts")
    late = p.where(F.col("ts") >= F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")).drop("ts")
    older, newer = M.mention_series(early, "HR"), M.mention_series(late, "HR")
    table = SK.BlockTable(spark, scratch_path(spark, "upsert_hr"), ["year", "month", "day", "hour", "ticker"],
                          SK.time_block("HR"), older.schema)
    table.merge(older, 0)
    table.merge(newer, 1)
    table.merge(newer, 1)  # a replayed batch starts from the state before it
    return table.read()


register("upsert_roundtrip", S.with_base(_HOURLY_SQL + "\nSELECT * FROM hourly"))(_upsert_roundtrip)

_LINES_SQL = S.with_base("""
x AS (SELECT 1)
SELECT '{"id":' || id || ',"created_at":"' || strftime(pts, '%a %b %d %H:%M:%S +0000 %Y') || '","text":"' || text
       || '","user":{"followers_count":' || followers || ',"friends_count":' || friends
       || ',"description":"fixture account","name":"' || uname || '"}}' AS value
FROM posts""")


def _staged_posts(spark, d, n_files=8, ordered=False):
    df = FX.post_lines(FX.posts_from_events(FX.events(spark, d)), keep=("id",))
    return FX.stage_files(df, scratch_path(spark, "post_lines"), n_files, "id", ordered)


def _compacted(spark, d):
    src = _staged_posts(spark, d)
    return SK.compact_lines(spark, src, scratch_path(spark, "compacted"))


register("compacted_lines", _LINES_SQL)(_compacted)


def _result_text(spark, d):
    df = M.trending(posts(spark, d), "HR", k=5)
    path = scratch_path(spark, "result_hr")
    SK.write_results(df, path, "json")
    return spark.read.schema(df.schema).json(path)


register("result_text", _rank_sql("HR", 5))(_result_text)


# ---- streaming ------------------------------------------------------------------------------
def _state_partitions(spark) -> int:
    """State/shuffle partitions for the fixture streams: sized to the cores,
    since the staged feed is small; the count is kept in each checkpoint."""
    return spark.sparkContext.defaultParallelism


def _stream_totals(spark, d, watermark=None, src=None):
    src = src or _staged_posts(spark, d, 8, ordered=watermark is not None)
    q, table = STOT.run_totals(spark, SSRC.read_post_stream(spark, src, 1), "HR", scratch_path(spark, "totals"),
                               scratch_path(spark, "totals_ckpt"), watermark=watermark,
                               state_partitions=_state_partitions(spark))
    q.awaitTermination()
    return table.read().select("year", "month", "day", "hour", "ticker", "frequency", "sentiment")


register("stream_mention_series_hr", S.with_base(_HOURLY_SQL + "\nSELECT * FROM hourly"))(_stream_totals)


def _stream_additive(spark, d):
    src = _staged_posts(spark, d, 8)
    q, table = STOT.run_totals_additive(spark, SSRC.read_post_stream(spark, src, 1), "HR",
                                        scratch_path(spark, "additive"), scratch_path(spark, "additive_ckpt"),
                                        state_partitions=_state_partitions(spark))
    q.awaitTermination()
    return table.read().select("year", "month", "day", "hour", "ticker", "frequency", "sentiment")


register("stream_mention_series_additive", S.with_base(_HOURLY_SQL + "\nSELECT * FROM hourly"))(_stream_additive)
# Six arrivals of equal time spans. Every 97th post comes three spans late, far behind the
# watermark; nothing is posted on the 15th, so that snapshots fade and are empty; a tick every
# five minutes drives time.
_SPANS, _LATE_BY, _LATE_EVERY, _QUIET_DAY = 6, 3, 97, 15

register("stream_watermarked", S.with_base(_HOURLY_SQL + "\nSELECT * FROM hourly"))(
    lambda spark, d: _stream_totals(spark, d, watermark="1 hour"))


def _late_totals(spark, d, grain, watermark):
    """Six arrivals, every 97th post three spans late: behind the watermark, unless its bucket is still open."""
    src, path, ckpt = (scratch_path(spark, f"late_{x}") for x in ("src", "totals", "ckpt"))
    for arrived, _ in _spans(spark, d):
        FX.post_lines(arrived).write.mode("append").text(src)
        q, table = STOT.run_totals(spark, SSRC.read_post_stream(spark, src, 10_000), grain, path, ckpt, watermark=watermark,
                                   state_partitions=_state_partitions(spark))
        q.awaitTermination()
    return table.read()


def _late_sql(grain, open_at):
    return S.with_base(f"""
bounds AS (SELECT min(epoch(pts)::BIGINT) AS first, max(epoch(pts)::BIGINT) AS last FROM posts WHERE day(pts) <> {_QUIET_DAY}),
spans AS (SELECT occ.*, floor((epoch(pts)::BIGINT - first) * {_SPANS} / (last - first + 1)) AS span FROM occ, bounds WHERE day(pts) <> {_QUIET_DAY})
SELECT {S.part_select(grain, 'pts')}, ticker, count(*) AS frequency, CAST(sum(score) AS BIGINT) AS sentiment
FROM spans WHERE NOT (id % {_LATE_EVERY} = 0 AND span + {_LATE_BY} < {_SPANS}) OR {open_at}
GROUP BY ALL""")


def _stream_sliding(spark, d):
    src = _staged_posts(spark, d, 8)
    q, table = STRD.run_sliding_counts(spark, SSRC.read_post_stream(spark, src, 1), scratch_path(spark, "slide"),
                                       scratch_path(spark, "slide_ckpt"), state_partitions=_state_partitions(spark))
    q.awaitTermination()
    return table.read()


register("stream_sliding_counts", S.with_base(_SLIDING_SQL + "\nSELECT * FROM counts"))(_stream_sliding)


def _trending_run(spark, arrivals, **options):
    """The trending stream over arrivals, each a pair of posts and ticks (ts):
    the query is started again for each of them and goes on from its
    checkpoint. Returns the paths of counts and snapshots."""
    src, clock, counts, snapshots, ckpt = (scratch_path(spark, f"trending_{x}") for x in ("src", "clock", "counts", "snaps", "ckpt"))
    for arrived, ticks in arrivals:
        FX.post_lines(arrived).write.mode("append").text(src)
        ticks.write.mode("append").parquet(clock)
        q = STRD.run_top_trending(spark, SSRC.read_post_stream(spark, src, 10_000), counts, snapshots, ckpt,
                                  state_partitions=_state_partitions(spark), ticks=SSRC.read_tick_stream(spark, clock), **options)
        q.awaitTermination()
    return counts, snapshots


def _post_second():
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts"))


def _closed_feed(spark, d, after: int):
    """All posts, then a tick that ends the windows up to ``after`` seconds
    after the newest post (its pane included); the watermark is 10 seconds behind it."""
    p = posts(spark, d)
    pane_end = (F.floor(F.max(_post_second()) / 5) + 1) * 5
    close = M.post_times(p).agg(F.timestamp_seconds(pane_end + after + 10).alias("ts"))
    return [(p, close.where("false")), (p.where("false"), close)]


def _stream_sliding_panes(spark, d):
    return STRD.read_counts(spark, _trending_run(spark, _closed_feed(spark, d, 600))[0])


def _stream_top5(spark, d):
    snapshots = STRD.read_snapshots(spark, _trending_run(spark, _closed_feed(spark, d, 600))[1])
    return snapshots.where("ticker IS NOT NULL").select(
        "ticker", F.col("timestamp").alias("window_end_ms"), "frequency", "sentiment", "id")


register("stream_sliding_counts_panes", S.with_base(_SLIDING_SQL + "\nSELECT * FROM counts"))(_stream_sliding_panes)
register("stream_top5", S.with_base(_TOP5_SQL + "\nSELECT * FROM top5"))(_stream_top5)

def _spans(spark, d):
    # Spans go by the events' own times, which the posts repeat: filters on parsed times would parse them many times over.
    ev = FX.events(spark, d).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    p = FX.posts_from_events(ev, keep=("ts",)).where(F.dayofmonth("ts") != _QUIET_DAY).withColumn("t", _post_second())
    first, last = p.agg(F.min("t"), F.max("t")).first()
    seconds, step = last - first + 1, 300
    span = F.floor((F.col("t") - first) * _SPANS / seconds)
    late = (F.col("id") % _LATE_EVERY == 0) & (span + _LATE_BY < _SPANS)
    p = p.withColumn("arrival", F.when(late, span + _LATE_BY).otherwise(span))
    ticks = spark.range(0, seconds // step + 4).select(
        F.timestamp_seconds(F.col("id") * step + first).alias("ts"),
        F.least(F.floor(F.col("id") * step * _SPANS / seconds), F.lit(_SPANS - 1)).alias("arrival"))
    columns = posts(spark, d).columns
    return [(p.where(F.col("arrival") == i).select(*columns), ticks.where(F.col("arrival") == i).select("ts")) for i in range(_SPANS)]


def _stream_snapshots(spark, d):
    _, snapshots = _trending_run(spark, _spans(spark, d), slide="60 seconds", watermark="5 minutes")
    return STRD.read_snapshots(spark, snapshots).drop("written_at")


register("stream_snapshots", S.with_base(f"""
fed AS (SELECT *, epoch(pts)::BIGINT AS t FROM occ WHERE day(pts) <> {_QUIET_DAY}),
bounds AS (SELECT min(t) AS first, max(t) AS last FROM (SELECT epoch(pts)::BIGINT AS t FROM posts WHERE day(pts) <> {_QUIET_DAY})),
span AS (SELECT first, last, last - first + 1 AS seconds FROM bounds),
in_time AS (
  SELECT f.* FROM fed f, span
  WHERE NOT (f.id % {_LATE_EVERY} = 0 AND floor((f.t - first) * {_SPANS} / seconds) + {_LATE_BY} < {_SPANS})
),
ticks AS (SELECT first + unnest(generate_series(0, seconds // 300 + 3)) * 300 AS t FROM span),
minutes AS (
  SELECT t // 60 AS m, ticker, count(*) AS n, sum(score) AS sc FROM in_time GROUP BY ALL
  UNION ALL SELECT DISTINCT t // 60, '', 0, 0 FROM ticks
),
wins AS (
  SELECT (m + i) * 60 AS ended, ticker, sum(n) AS n, sum(sc) AS sc
  FROM minutes, generate_series(1, 10) AS g(i) GROUP BY ALL
),
closed AS (SELECT * FROM wins WHERE ended <= (SELECT max(t) - 300 FROM ticks)),
ranked AS (
  SELECT ended, ticker, n, sc, row_number() OVER (PARTITION BY ended ORDER BY n DESC, ticker) - 1 AS r
  FROM closed WHERE ticker <> ''
)
SELECT ended * 1000 AS timestamp, CAST(r AS BIGINT) AS id, ticker, CAST(n AS BIGINT) AS frequency, CAST(sc AS BIGINT) AS sentiment
FROM ranked WHERE r < 5
UNION ALL
SELECT DISTINCT ended * 1000, 0, NULL, 0, 0 FROM closed WHERE ended NOT IN (SELECT ended FROM ranked)"""))(_stream_snapshots)


# A day is closed long before its late posts come; the month is open to its end.
register("stream_late_days", _late_sql("DAY", "false"))(lambda spark, d: _late_totals(spark, d, "DAY", "1 hour"))
register("stream_late_months", _late_sql("MONTH", "true"))(lambda spark, d: _late_totals(spark, d, "MONTH", "1 hour"))


def _landed(spark, d):
    src = _staged_posts(spark, d, 8)
    out = scratch_path(spark, "landed")
    lines = spark.readStream.format("text").option("maxFilesPerTrigger", 2).load(src)
    q = SLAND.land_raw(lines, out, scratch_path(spark, "landed_ckpt"), 15, 1000,
                       state_partitions=_state_partitions(spark))
    q.awaitTermination()
    return spark.read.text(out).select("value")


register("stream_landed_raw", _LINES_SQL)(_landed)

# ---- list form, global order, chart tuples ----------------------------------------------------
register("top5_lists_per_hour", S.with_base(_HOURLY_SQL + """
, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY year, month, day, hour ORDER BY frequency DESC, ticker) AS rank
  FROM hourly)
SELECT year, month, day, hour, list(ticker ORDER BY rank) AS tickers FROM ranked WHERE rank <= 5 GROUP BY ALL"""))(
    lambda spark, d: M.trending_lists(M.trending(posts(spark, d), "HR", k=5), "HR", 5))

register("mention_series_sorted", S.with_base(_HOURLY_SQL + "\nSELECT * FROM hourly"))(
    lambda spark, d: M.sorted_series(M.mention_series(posts(spark, d), "HR"), "HR"))

register("mention_chart_points", S.with_base(_MINUTE_SQL + """
SELECT ticker, epoch_ms(m) AS epoch_ms, '[' || epoch_ms(m) || ',' || frequency || ']' AS point FROM minute_series"""))(
    lambda spark, d: V.chart_points(V.mention_chart(M.mention_series(posts(spark, d), "MIN"))))

# ---- the same jobs over two years: month names, ISO year ends, clock changes ------------------


def _spread_posts(spark, d):
    return FX.posts_from_events(FX.events_over_years(FX.events(spark, d)))


def _spread_trades(spark, d):
    return FX.trades_from_events(FX.events_over_years(FX.events(spark, d)))


_BAR_VALUES_SQL = f"""max(price) AS high, min(price) AS low,
       arg_min(price, {{'u': {S.instant('time')}, 's': seq, 'p': price, 'q': quantity}}) AS open,
       arg_max(price, {{'u': {S.instant('time')}, 's': seq, 'p': price, 'q': quantity}}) AS close,
       sum(quantity) AS volume"""

for _g in ("YEAR", "MONTH", "WEEK", "DAY", "HR"):
    _sfx = _GRAIN_SUFFIX[_g]
    register(f"mention_series_{_sfx}_two_years", S.with_spread_base(f"""
x AS (SELECT 1)
SELECT {S.part_select(_g, 'pts')}, ticker, count(*) AS frequency, CAST(sum(score) AS BIGINT) AS sentiment
FROM occ GROUP BY ALL"""))((lambda g: lambda spark, d: M.mention_series(_spread_posts(spark, d), g))(_g))
    register(f"bars_{_sfx}_two_years", S.with_spread_base(f"""
x AS (SELECT 1)
SELECT ticker, {S.part_select(_g, 'lt')}, {_BAR_VALUES_SQL}
FROM trades GROUP BY ALL"""))((lambda g: lambda spark, d: B.price_bars(_spread_trades(spark, d), g))(_g))


def _spread_post_times(spark, d):
    p = M.post_times(_spread_posts(spark, d))
    return p.select("id", "created_at", *TF.grain_parts(F.col("ts"), "SEC"))


register("post_times_two_years", S.with_spread_base("""
x AS (SELECT 1)
SELECT id, strftime(pts, '%a %b %d %H:%M:%S +0000 %Y') AS created_at,
       CAST(year(pts) AS INTEGER) AS year, CAST(month(pts) AS INTEGER) AS month, CAST(day(pts) AS INTEGER) AS day,
       CAST(hour(pts) AS INTEGER) AS hour, CAST(minute(pts) AS INTEGER) AS minute,
       CAST(floor(second(pts)) AS INTEGER) AS second
FROM posts"""))(_spread_post_times)


def _spread_week_labels(spark, d):
    p = M.post_times(_spread_posts(spark, d))
    iso = TF.grain_parts(F.col("ts"), "WEEK")
    cal = TF.grain_parts(F.col("ts"), "WEEK", week_year="calendar")
    return p.select("id", iso[0].alias("week_year"), iso[1].alias("week"),
                    F.concat_ws("-", cal[0], cal[1]).alias("calendar_label"))


register("week_labels_two_years", S.with_spread_base("""
x AS (SELECT 1)
SELECT id, CAST(isoyear(pts) AS INTEGER) AS week_year, CAST(week(pts) AS INTEGER) AS week,
       CAST(year(pts) AS VARCHAR) || '-' || CAST(week(pts) AS VARCHAR) AS calendar_label
FROM posts"""))(_spread_week_labels)

_TIED_SQL = """tied AS (
  SELECT ticker, date_trunc('hour', time) AS time, CASE WHEN seq % 10 <> 0 THEN price END AS price, quantity
  FROM trades),
placed AS (
  SELECT *, timezone('America/Los_Angeles', u) AS lt FROM (SELECT *, {instant} AS u FROM tied))"""
register("bars_ties", S.with_spread_base(f"""
{_TIED_SQL.format(instant=S.instant('time'))}
SELECT ticker, {S.part_select('DAY', 'lt')}, max(price) AS high, min(price) AS low,
       arg_min(price, {{'u': u, 'p': price, 'q': quantity}}) FILTER (price IS NOT NULL) AS open,
       arg_max(price, {{'u': u, 'p': price, 'q': quantity}}) FILTER (price IS NOT NULL) AS close, sum(quantity) AS volume
FROM placed GROUP BY ALL"""))(lambda spark, d: B.price_bars(FX.trades_with_ties(FX.events(spark, d)), "DAY"))


def _malformed(spark, d):
    good, bad = R.parse_trade_lines(FX.broken_trade_lines(FX.events(spark, d)), with_rejects=True)
    good = good.select(F.lit("trade").alias("kind"), F.concat_ws(
        "|", "ticker", TF.format_local_time(F.col("time")), F.col("price").cast("string"), F.coalesce("board", F.lit("-"))).alias("row"))
    return good.unionByName(bad.select(F.lit("reject").alias("kind"), F.col("value").alias("row")))


register("trades_malformed", S.with_base("""
t AS (SELECT *, strftime(time, '%Y-%m-%d %H:%M:%S') AS tm, seq % 20 AS which FROM trades)
SELECT 'trade' AS kind, ticker || '|' || tm || '|' || CAST(price AS VARCHAR) || '|' || CASE WHEN which = 1 THEN '-' ELSE 'b' END AS row
FROM t WHERE which NOT IN (0, 2, 3, 4)
UNION ALL
SELECT 'reject', CASE which WHEN 0 THEN 'garbage' WHEN 2 THEN '1.0,' || ticker || ',' || tm || ',many,1,b,s,,,'
       ELSE '1.0,' || ticker || ',noon,' || CAST(price AS VARCHAR) || ',1,b,s,,,' END
FROM t WHERE which IN (0, 2, 3)"""))(_malformed)


def _bare_messages(spark, d):
    m = R.explode_message_batches(FX.bare_message_arrays(posts(spark, d)))
    return m.select("id", "created_at", "text", F.col("user.name").alias("name"))


register("message_arrays_exploded", S.with_base("""
x AS (SELECT 1)
SELECT id, strftime(pts, '%a %b %d %H:%M:%S +0000 %Y') AS created_at, text, uname AS name FROM posts"""))(_bare_messages)


def _lexicon_join(spark, d):
    from tickerlens.functions.lexicon import DEFAULT_LEXICON

    return M.mention_series_with_lexicon(posts(spark, d), "HR", DEFAULT_LEXICON.as_dataframe(spark))


register("mention_series_lexicon_join", S.with_base(_HOURLY_SQL + "\nSELECT * FROM hourly"))(_lexicon_join)


# ---- files written as their producers write them, read by the readers --------------------------
def _universe_files(spark, d):
    path = scratch_path(spark, "universes")
    u = _universe(spark, d)
    u.where("list = 'A'").select("Ticker", "Code", "Name").write.option("header", True).csv(f"{path}/A")
    u.where("list = 'B'").select("Code", "Name").write.csv(f"{path}/ALL")
    both = R.read_universe(spark, f"{path}/A", "A").unionByName(R.read_universe(spark, f"{path}/ALL", "B", "all"))
    return both.select("list", "Ticker", "Code", "Name")


register("universe_files", S.with_base(_UNIVERSE_SQL + """
SELECT list, Ticker, 'GOOG/NYSE_' || Ticker AS Code, 'Company ' || Ticker AS Name FROM universe"""))(_universe_files)


def _backup_files(spark, d):
    path = scratch_path(spark, "backup")
    b = FX.backup_bars_from_trades(trades(spark, d))
    b.select("epoch", "close", "high", "low", "open", "volume").write.csv(path)
    return B.backup_to_minute_bars(R.read_backup_bars(spark, path), ticker="ONE").drop("ticker")


register("backup_files", S.with_base(f"""
backup AS (
  SELECT ticker, CAST(floor(epoch(timezone('Europe/Oslo', time)) / 60) AS BIGINT) * 60 AS epoch,
         arg_max(price, {{'t': time, 's': seq}}) AS close, max(price) AS high, min(price) AS low,
         arg_min(price, {{'t': time, 's': seq}}) AS open, CAST(count(*) AS DOUBLE) AS volume
  FROM trades GROUP BY ALL),
bl AS (SELECT *, timezone('America/Los_Angeles', to_timestamp(epoch)) AS loc FROM backup)
SELECT {S.part_select('MIN', 'loc')}, high, low, open, close, volume, epoch FROM bl"""))(_backup_files)


# ---- ordered outputs: the position is the place in the rows as they come out -------------------
register("mention_chart_positions", S.with_base(_MINUTE_SQL + """
SELECT ticker, epoch_ms(m) AS epoch_ms, frequency, CAST(sign(sentiment) AS INTEGER) AS sign,
       row_number() OVER (PARTITION BY ticker ORDER BY m) AS position FROM minute_series"""))(
    lambda spark, d: V.with_position(V.mention_chart(M.mention_series(posts(spark, d), "MIN")), "ticker"))

register("overlay_positions", S.with_base(_MINUTE_SQL + """
, keys AS (
  SELECT ticker, epoch_ms(timezone('America/Los_Angeles', date_trunc('minute', lt))) AS epoch_ms FROM trades
  UNION SELECT ticker, epoch_ms(m) FROM minute_series)
SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY epoch_ms) AS position FROM keys"""))(
    lambda spark, d: V.with_position(V.price_mention_overlay(
        B.price_bars(trades(spark, d), "MIN"), M.mention_series(posts(spark, d), "MIN")), "ticker")
    .select("ticker", "epoch_ms", "position"))

register("sorted_series_positions", S.with_base(_HOURLY_SQL + """
SELECT *, row_number() OVER (PARTITION BY year, month, day, hour ORDER BY frequency DESC, ticker) AS position FROM hourly"""))(
    lambda spark, d: V.with_position(M.sorted_series(M.mention_series(posts(spark, d), "HR"), "HR"),
                                     "year", "month", "day", "hour"))


def _clustered(spark, d):
    """Rows of the series table in the order in which its files hold them."""
    path = scratch_path(spark, "series_order")
    SK.write_series(M.mention_series(posts(spark, d), "HR"), path, "HR")
    rows = spark.read.parquet(path).withColumns({"_f": F.col("_metadata.file_path"), "_p": F.col("_metadata.row_index")})
    from pyspark.sql import Window

    rows = rows.withColumn("position", F.row_number().over(Window.partitionBy("_f", "ticker").orderBy("_p")).cast("long"))
    return rows.select("ticker", "year", "month", "day", "hour", "position")


register("series_table_order", S.with_base(_HOURLY_SQL + """
SELECT ticker, year, month, day, hour,
       row_number() OVER (PARTITION BY ticker, year, month ORDER BY day DESC, hour DESC) AS position FROM hourly"""))(_clustered)

for _name, _interval, _sql in (
        ("30min", "30 MINUTES", "INTERVAL 30 MINUTE"), ("1h", "1 HOUR", "INTERVAL 1 HOUR"), ("1d", "1 DAY", "INTERVAL 1 DAY"),
        ("15d", "15 DAYS", "INTERVAL 15 DAY"), ("1month", "1 MONTH", "INTERVAL 1 MONTH"), ("all", None, None)):
    def _lookback(spark, d, interval=_interval):
        path = scratch_path(spark, "series_min")
        M.mention_series(posts(spark, d), "MIN").write.parquet(path)
        return V.lookback(spark.read.parquet(path), "MIN", interval)

    register(f"lookback_{_name}", S.with_base(_MINUTE_SQL + f"""
SELECT ticker, epoch_ms(m) AS bucket_ms, strftime(m - INTERVAL 5 HOUR, '%Y-%m-%d %H:%M') AS display, frequency, sentiment
FROM minute_series""" + (f" WHERE m > (SELECT max(m) FROM minute_series) - {_sql}" if _sql else "")))(_lookback)

# ---- both sides of an overlap differ, so the wrong winner shows ---------------------------------
_OVERLAP_SQL = _HOURLY_SQL + """
, doubled AS (
  SELECT h.* REPLACE (frequency * 2 AS frequency) FROM hourly h WHERE make_timestamp(year, month, day, hour, 0, 0) >= TIMESTAMP '2024-01-10')"""


def _two_versions(spark, d):
    """The hourly series before 2024-01-20, and a newer version from 2024-01-10 on with doubled counts."""
    series = M.mention_series(posts(spark, d), "HR")
    day = F.col("year") * 10_000 + F.col("month") * 100 + F.col("day")
    old, new = series.where(day < 20_240_120), series.where(day >= 20_240_110)
    return old, new.withColumn("frequency", F.col("frequency") * 2)


def _upsert_versions(spark, d):
    old, new = _two_versions(spark, d)
    path = scratch_path(spark, "upsert_versions")
    for version, rows in ((1, new), (0, old)):  # also when the older version is written later
        rows.withColumn("version", F.lit(version)).write.mode("append").partitionBy("version").parquet(path)
    return K.latest_per_key(spark.read.parquet(path), ["year", "month", "day", "hour", "ticker"], "version").drop("version")


register("upsert_newer_wins", S.with_base(_OVERLAP_SQL + """
SELECT * FROM doubled UNION ALL SELECT * FROM hourly
WHERE make_timestamp(year, month, day, hour, 0, 0) < TIMESTAMP '2024-01-10'"""))(_upsert_versions)

for _mode, _where_old, _where_new in (
        ("cutoff", "< TIMESTAMP '2024-01-15'", ">= TIMESTAMP '2024-01-15'"),
        ("replace", "< TIMESTAMP '2024-01-10'", ">= TIMESTAMP '2024-01-10'")):
    def _merge(spark, d, mode=_mode):
        return V.merge_views(*_two_versions(spark, d), "HR", "2024-01-15 00:00:00", mode)

    register(f"merged_views_{_mode}", S.with_base(_OVERLAP_SQL + f"""
SELECT * FROM doubled WHERE make_timestamp(year, month, day, hour, 0, 0) {_where_new}
UNION ALL SELECT * FROM hourly WHERE make_timestamp(year, month, day, hour, 0, 0) {_where_old}"""))(_merge)


# ---- the snapshots that the stream wrote ----------------------------------------------------------
def _stream_panel(spark, d):
    # The newest window that has ended is the one that ends right after the newest post.
    snapshots = STRD.read_snapshots(spark, _trending_run(spark, _closed_feed(spark, d, 0))[1])
    return V.live_panel(snapshots.where(F.col("timestamp") == snapshots.select(F.max("timestamp")).scalar()))


register("live_panel_streamed", S.with_base(_SLIDING_SQL + """
, panel AS (
  SELECT *, row_number() OVER (ORDER BY frequency DESC, ticker) AS r FROM counts
  WHERE window_end_ms = (SELECT (CAST(floor(epoch(max(pts)) / 5) AS BIGINT) + 1) * 5000 FROM occ))
SELECT CAST(row_number() OVER (ORDER BY frequency, r) AS BIGINT) AS position, ticker, frequency,
       CASE WHEN sentiment > 0 THEN 'green' WHEN sentiment < 0 THEN 'red' ELSE 'blue' END AS colour
FROM panel WHERE r <= 5"""))(_stream_panel)

for _g in ("MIN", "DAY", "WEEK", "MONTH", "YEAR"):
    def _stream_grain(spark, d, grain=_g):
        q, table = STOT.run_totals(spark, SSRC.read_post_stream(spark, _staged_posts(spark, d, 3), 1), grain,
                                   scratch_path(spark, "totals_g"), scratch_path(spark, "totals_g_ckpt"),
                                   state_partitions=_state_partitions(spark))
        q.awaitTermination()
        return table.read()

    register(f"stream_mention_series_{_GRAIN_SUFFIX[_g]}", S.with_base(f"""
x AS (SELECT 1)
SELECT {S.part_select(_g, 'pts')}, ticker, count(*) AS frequency, CAST(sum(score) AS BIGINT) AS sentiment
FROM occ GROUP BY ALL"""))(_stream_grain)


# ---- one pass: tagged posts, all grains; files by bytes; order of arrival ----------------------
def _tagged_rows(tagged):
    good = F.concat_ws("|", F.col("id").cast("string"), TF.format_local_time(F.col("ts")), "text")
    return tagged.select("status", F.when(F.col("status") == "good", good).otherwise(F.col("value")).alias("row"))


def _posts_tagged(spark, d):
    path = scratch_path(spark, "tagged")
    R.write_tagged(R.tag_posts(FX.broken_post_lines(FX.events(spark, d))), path)
    return _tagged_rows(spark.read.parquet(path))


def _stream_posts_tagged(spark, d):
    src, out = scratch_path(spark, "broken"), scratch_path(spark, "tagged_stream")
    FX.stage_files(FX.broken_post_lines(FX.events(spark, d)), src, 8, "id")
    lines = spark.readStream.format("text").option("maxFilesPerTrigger", 4).load(src)
    tagged = R.count_status(R.tag_posts(lines), "posts")
    w = (tagged.writeStream.format("parquet").partitionBy("status").option("path", out)
         .option("checkpointLocation", scratch_path(spark, "tagged_ckpt")).trigger(availableNow=True))
    start_stream(w, spark, _state_partitions(spark)).awaitTermination()
    return _tagged_rows(spark.read.parquet(out))


_TAGGED_SQL = S.with_base("""
t AS (
  SELECT *, id % 20 AS which, strftime(pts, '%a %b %d %H:%M:%S +0000 %Y') AS made FROM posts),
r AS (
  SELECT CASE which WHEN 0 THEN 'json' WHEN 1 THEN 'text' WHEN 2 THEN 'time' WHEN 3 THEN 'time' ELSE 'good' END AS status,
         CASE WHEN which = 0 THEN '{"id": ' || id || ', "text": '
              WHEN which < 4 THEN '{"id":' || id
                   || CASE which WHEN 1 THEN ',"created_at":"' || made || '"'
                                 WHEN 2 THEN ',"created_at":"noon","text":"' || text || '"'
                                 ELSE ',"text":"' || text || '"' END
                   || ',"user":{"followers_count":' || followers || ',"friends_count":' || friends
                   || ',"description":"fixture account","name":"' || uname || '"}}'
              ELSE id || '|' || strftime(pts, '%Y-%m-%d %H:%M:%S') || '|' || text END AS row
  FROM t WHERE which <> 4)
SELECT status, row FROM r""")
register("posts_tagged", _TAGGED_SQL)(_posts_tagged)
register("stream_posts_tagged", _TAGGED_SQL)(_stream_posts_tagged)


def _all_grains(spark, d):
    tables = SK.write_all_grains(_spread_posts(spark, d), scratch_path(spark, "all_grains"))
    out = None
    for grain, t in tables.items():
        rows = t.select(F.lit(grain).alias("grain"), TF.format_local_time(TF.parts_to_timestamp(grain)).alias("bucket"),
                        "ticker", "frequency", "sentiment")
        out = rows if out is None else out.unionByName(rows)
    return out


register("series_all_grains", S.with_spread_base("x AS (SELECT 1)" + " UNION ALL ".join(f"""
SELECT '{_g}' AS grain, strftime(date_trunc('{_unit}', pts), '%Y-%m-%d %H:%M:%S') AS bucket, ticker,
       count(*) AS frequency, CAST(sum(score) AS BIGINT) AS sentiment
FROM occ GROUP BY ALL""" for _g, _unit in (("MIN", "minute"), ("HR", "hour"), ("DAY", "day"), ("WEEK", "week"),
                                         ("MONTH", "month"), ("YEAR", "year")))))(_all_grains)


_ROLL = 20_000  # bytes, so that a block of the fixture has several files


def _landed_by_bytes(spark, d):
    lines = FX.post_lines(FX.posts_from_events(FX.events(spark, d), keep=("ts",)), keep=("ts",))
    path = scratch_path(spark, "landed_bytes")
    SLAND.write_byte_files(SLAND.byte_files(lines, F.col("ts"), 0, _ROLL, deals=1), path)
    return (SLAND.read_byte_files(spark, path).groupBy("file")
            .agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.octet_length("value") + 1).alias("n_bytes")))


register("landed_by_bytes", _LINES_SQL.replace("SELECT '{", "SELECT ts, '{").replace("x AS (SELECT 1)", "lines AS (")
         + f""" JOIN ev ON event_id = id),
run AS (
  SELECT strftime(ts, '%Y-%m-%d') AS block, strlen(value) + 1 AS b,
         sum(strlen(value) + 1) OVER (PARTITION BY date_trunc('day', ts) ORDER BY ts, value
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM lines)
SELECT block || '_' || CAST((upto - b) // {_ROLL} AS BIGINT) AS file, count(*) AS n_lines, CAST(sum(b) AS BIGINT) AS n_bytes
FROM run GROUP BY 1""")(_landed_by_bytes)


def _stream_landed_by_bytes(spark, d):
    out = scratch_path(spark, "landed_bytes_stream")
    lines = spark.readStream.format("text").option("maxFilesPerTrigger", 4).load(_staged_posts(spark, d, 8))
    SLAND.land_by_bytes(lines, out, scratch_path(spark, "landed_bytes_ckpt"), max_bytes=100_000,
                        state_partitions=_state_partitions(spark)).awaitTermination()
    return spark.read.text(out).select("value")


register("stream_landed_by_bytes", _LINES_SQL)(_stream_landed_by_bytes)


def _bars_arrival(spark, d):
    ev = FX.events(spark, d)
    read = lambda e, name: R.number_lines(spark, FX.dump_folder(e, scratch_path(spark, name)),
                                          "value string, ticker string").withColumnRenamed("value", "line")
    new, old = read(ev, "dump_new"), read(ev.where(F.col("event_id") % 3 != 0), "dump_old")
    return B.price_bars(R.trades_from_lines(R.normalize_trade_dump(new, old, INGEST_EPOCH)), "DAY")


register("bars_arrival_order", S.with_base(f"""
seen AS (
  SELECT ticker, date_trunc('hour', time) AS time, price, quantity, min(seq) AS seq, bool_or(seq % 3 <> 0) AS was
  FROM trades GROUP BY ticker, date_trunc('hour', time), price, quantity),
placed AS (
  SELECT *, timezone('America/Los_Angeles', timezone('Europe/Oslo', time)) AS lt FROM seen WHERE NOT was)
SELECT ticker, {S.part_select('DAY', 'lt')}, max(price) AS high, min(price) AS low,
       arg_min(price, {{'t': time, 's': seq}}) AS open, arg_max(price, {{'t': time, 's': seq}}) AS close,
       sum(quantity) AS volume
FROM placed GROUP BY ALL"""))(_bars_arrival)


# ---- queries on stored tables ---------------------------------------------------------------
def _trending_stored(spark, d):
    """The hour's folder alone is read, by its partition filter."""
    series, path = M.mention_series(posts(spark, d), "HR"), scratch_path(spark, "trending_hr")
    SK.write_trending(series, path, "HR")
    return V.trending_at(spark.read.schema(series.schema).parquet(path), "2024_01_15_09", "America/New_York")


register("trending_at_stored_hour", QUERIES["trending_at_eastern_hour"][1])(_trending_stored)


def _colocated(spark, d):
    """Minute bars and the minute series, bucketed alike under names of their own."""
    sides = {"bars": V.bars_on_axis(B.price_bars(trades(spark, d), "MIN")), "mentions": V.mentions_on_axis(M.mention_series(posts(spark, d), "MIN"))}
    made = []
    for name, rows in sides.items():
        path = scratch_path(spark, f"axis_{name}")
        made.append(SK.write_colocated(rows, path.rsplit("/", 1)[1].replace("-", "_"), path, _state_partitions(spark)))
    return made


register("overlay_colocated", QUERIES["price_mention_overlay"][1])(lambda spark, d: V.stored_overlay(*_colocated(spark, d)))
register("overlay_colocated_hot", f"SELECT * FROM ({QUERIES['price_mention_overlay'][1]}) WHERE ticker = 'ZZZ'")(
    lambda spark, d: V.stored_overlay(*_colocated(spark, d), ticker="ZZZ"))

register("trending_by_eastern_hour_two_years", S.with_spread_base(_HOURLY_SQL + f"""
, l AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY year, month, day, hour ORDER BY frequency DESC, ticker) AS BIGINT) AS rank,
         make_timestamp(year, month, day, hour, 0, 0) AS u,
         timezone('America/New_York', timezone('UTC', make_timestamp(year, month, day, hour, 0, 0))) AS w FROM hourly)
SELECT strftime(w, '%Y_%m_%d_%H') ||
       CASE WHEN w IN (TIMESTAMP '2024-11-03 01:00:00', TIMESTAMP '2025-11-02 01:00:00', TIMESTAMP '2026-11-01 01:00:00')
            THEN '-0' || date_diff('hour', w, u) ELSE '' END AS local_hour, ticker, frequency, {_COLOUR}, rank
FROM l WHERE rank <= 10"""))(
    lambda spark, d: V.trending_by_local_hour(M.mention_series(_spread_posts(spark, d), "HR"), "America/New_York"))

register("merged_views_add", S.with_base(_OVERLAP_SQL + """
, added AS (
  SELECT * FROM doubled WHERE make_timestamp(year, month, day, hour, 0, 0) >= TIMESTAMP '2024-01-10'
  UNION ALL SELECT * FROM hourly WHERE make_timestamp(year, month, day, hour, 0, 0) < TIMESTAMP '2024-01-20')
SELECT year, month, day, hour, ticker, CAST(sum(frequency) AS BIGINT) AS frequency,
       CAST(sum(sentiment) AS BIGINT) AS sentiment FROM added GROUP BY ALL"""))(
    lambda spark, d: V.merge_views(*_two_versions(spark, d), "HR", None, "add"))
