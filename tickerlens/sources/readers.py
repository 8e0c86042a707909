"""Readers for the raw feeds (SRC-1..7) and the trade-dump ingest (JOB-8).

Raw text is read with ``spark.read.text`` (paths and globs), parsed with
built-in ``from_json`` / ``split`` against explicit schemas: no inference,
no Python per row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tickerlens.functions.timefn import parse_local_time, parse_post_time, reformat_compact_time
from tickerlens.schemas import (BACKUP_BAR, MESSAGE_RESPONSE, POST, POST_WITH_CORRUPT,
                                TRADE_DUMP_HEADER, TRADE_LINE_FIELDS, UNIVERSE)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text line scan of a path or glob (SRC-1): one ``value`` per line."""
    return spark.read.text(path)


def parse_posts(lines: DataFrame, with_rejects: bool = False):
    """JSON post strings in ``value`` (e.g. bus messages) -> typed posts
    (SRC-2, PRJ-1, PRJ-2, JSN-1, FLT-2).

    Permissive: a malformed line does not fail the job; posts without
    ``text`` are dropped. Without rejects the parse carries no corrupt-record
    column, so Catalyst prunes ``from_json`` to the fields a query uses. With
    ``with_rejects=True`` returns ``(posts, rejects)`` where rejects hold the
    raw lines that did not parse.
    """
    if not with_rejects:
        j = F.from_json(F.col("value"), POST, {"mode": "PERMISSIVE"})
        return (lines.select(j.alias("j")).select(*[F.col("j." + f.name).alias(f.name) for f in POST.fields])
                .where(F.col("text").isNotNull()))
    parsed = lines.select(F.from_json(F.col("value"), POST_WITH_CORRUPT,
                                      {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
                          .alias("j"), "value")
    bad = F.col("j._corrupt_record").isNotNull() | F.col("j").isNull()
    good = parsed.where(~bad).select(*[F.col("j." + f.name).alias(f.name) for f in POST.fields])
    return good.where(F.col("text").isNotNull()), parsed.where(bad).select("value")


#: What ``tag_posts`` says of a line, in the order of its checks.
POST_STATUS = ("json", "text", "time", "good")


def tag_posts(lines: DataFrame) -> DataFrame:
    """JSON post lines in ``value``, batch or stream -> the post fields, ``ts``
    (the parsed time), ``value`` and ``status``, in one pass (SRC-2, FLT-1, Q5).

    ``status`` is the first check that a line fails, ``json`` (it does not parse,
    or a field has another type), ``text`` or ``time`` (missing or unparseable),
    else ``good``. Every line that is not blank comes out once. ``value`` is kept
    for rejects only, so that good rows don't carry their text twice."""
    parsed = (lines.where(F.length(F.trim("value")) > 0)
              .select("value", F.from_json("value", POST_WITH_CORRUPT,
                                           {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
                      .alias("j")))
    timed = parsed.select("value", "j", parse_post_time(F.col("j.created_at")).alias("ts"))
    status = (F.when(F.col("j").isNull() | F.col("j._corrupt_record").isNotNull(), "json")
              .when(F.col("j.text").isNull(), "text").when(F.col("ts").isNull(), "time").otherwise("good"))
    out = timed.select(*[F.col("j." + f.name).alias(f.name) for f in POST.fields], "ts", "value",
                       status.alias("status"))
    return out.withColumn("value", F.when(F.col("status") != "good", F.col("value")))


def count_status(tagged: DataFrame, observation: Observation | str) -> DataFrame:
    """``tagged`` with its lines counted by status while they pass. A batch
    takes an ``Observation``; a stream takes a name, and its progress reports
    hold the counts of each micro-batch under it."""
    counts = [F.count_if(F.col("status") == s).alias(s) for s in POST_STATUS]
    return tagged.observe(observation, *counts)


def write_tagged(tagged: DataFrame, path: str) -> dict[str, int]:
    """Good posts and rejects into one table with a folder for each status:
    one scan writes both, and the counts come from the same pass."""
    seen = Observation()
    count_status(tagged, seen).write.mode("overwrite").partitionBy("status").parquet(path)
    return dict(seen.get)


def read_posts(spark: SparkSession, path: str) -> DataFrame:
    """JSON-line post files (path or glob) through the JSON data source with
    the explicit schema: each line is parsed once, only the columns a query
    uses are materialised, and malformed lines yield null fields (dropped by
    the ``text`` check) instead of failing the job. Use
    ``parse_posts(read_lines(...), with_rejects=True)`` to keep the rejects."""
    return (spark.read.schema(POST).option("mode", "PERMISSIVE").json(path)
            .where(F.col("text").isNotNull()))


def parse_trade_lines(lines: DataFrame, with_rejects: bool = False):
    """Comma trade lines -> ticker, time (wall clock string), price, quantity
    and the other fields, trimmed; empty lines dropped (SRC-3, FLT-1, STR-4, PRJ-5).

    Missing fields and malformed numbers or times become null; no line fails
    the job. ``with_rejects=True`` returns ``(trades, rejects)``: trades have a
    ticker, a time and a price, rejects hold the other non-empty lines."""
    parts = F.split(F.col("value"), ",")
    cols = [F.trim(F.get(parts, i)).alias(name) for i, name in enumerate(TRADE_LINE_FIELDS)]
    raw = lines.where(F.length("value") > 0).select("value", *cols)
    typed = raw.select(
        F.expr("try_cast(ingest_epoch AS DOUBLE)").alias("ingest_epoch"), "ticker",
        parse_local_time(F.col("time")).alias("time"),
        F.expr("try_cast(price AS DOUBLE)").alias("price"),
        F.expr("try_cast(quantity AS DOUBLE)").alias("quantity"),
        "board", "source", "buyer", "seller", "initiator", "value")
    if not with_rejects:
        return typed.drop("value")
    good = (F.length("ticker") > 0) & F.col("time").isNotNull() & F.col("price").isNotNull()
    good = F.coalesce(good, F.lit(False))
    return typed.where(good).drop("value"), typed.where(~good).select("value")


def read_trades(spark: SparkSession, path: str) -> DataFrame:
    """Trade-line files through the CSV data source (SRC-3): positional
    schema, surrounding blanks trimmed, empty lines skipped by the reader,
    malformed numbers null (PERMISSIVE). Only the columns a query uses are
    parsed. Returns the typed trade columns used by the bar operators."""
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField(n, T.DoubleType() if n in ("ingest_epoch", "price", "quantity")
                                         else T.StringType()) for n in TRADE_LINE_FIELDS])
    raw = (spark.read.schema(schema).option("mode", "PERMISSIVE").option("ignoreLeadingWhiteSpace", True)
           .option("ignoreTrailingWhiteSpace", True).csv(path))
    return raw.select("ticker", parse_local_time(F.col("time")).alias("time"),
                      "price", "quantity", _stamp_micros().alias("seq"))


def trades_from_lines(lines: DataFrame) -> DataFrame:
    """Typed trades for the bar operators; ``seq`` is the ingest stamp in
    microseconds (the producer stamps every line it publishes)."""
    t = parse_trade_lines(lines)
    return t.select("ticker", "time", "price", "quantity", _stamp_micros().alias("seq"))


def _stamp_micros():
    """The ingest stamp in whole microseconds (rounded: a double holds a stamp
    of this century to a quarter of one)."""
    return F.round(F.col("ingest_epoch") * 1_000_000).cast("long")


def read_backup_bars(spark: SparkSession, path: str) -> DataFrame:
    """Backup minute bars ``epoch,close,high,low,open,volume`` (SRC-5)."""
    return spark.read.csv(path, schema=BACKUP_BAR, header=False)


def read_universe(spark: SparkSession, path: str, list_name: str, layout: str = "columns") -> DataFrame:
    """One ticker-list CSV tagged with its list name (SRC-6). ``columns`` files
    have a header ``Ticker,Code,Name``; ``all`` files have no header and the
    code, ``<source>_<ticker>``, in column 1."""
    options = {"ignoreLeadingWhiteSpace": True, "ignoreTrailingWhiteSpace": True}
    if layout == "columns":
        rows = spark.read.csv(path, schema=UNIVERSE, header=True, **options)
    elif layout == "all":
        rows = spark.read.csv(path, schema="Code string, Name string", header=False, **options)
        rows = rows.select(F.regexp_extract("Code", r"([^_/]*)$", 1).alias("Ticker"), "Code", "Name")
    else:
        raise ValueError("layout must be 'columns' or 'all'")
    return rows.withColumn("list", F.lit(list_name))


def read_trade_dumps(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    """Vendor dump files ``<ticker><suffix>.csv`` (suffix ``New`` or ``Old``)
    of a folder -> ``(ticker, line)``, the ticker from the file name."""
    lines = spark.read.option("pathGlobFilter", f"*{suffix}.csv").text(path)
    name = F.regexp_extract(F.col("_metadata.file_name"), rf"^(.*){suffix}\.csv$", 1)
    return lines.select(name.alias("ticker"), F.col("value").alias("line"))


def number_lines(spark: SparkSession, path: str, schema: str = "value string") -> DataFrame:
    """Text files of a path or glob -> their columns, ``file`` and ``line_no``,
    a dense number from 0 over the lines of a file (blank ones included).

    A scan numbers the rows of a split without a gap; lines are counted per
    split, and running sums over a file's splits give each split its offset.
    Only that small table is joined to the lines, which stay where they are."""
    raw = (spark.read.schema(schema).text(path)
           .select("*", F.col("_metadata.file_path").alias("file"),
                   F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_id")))
    splits = raw.groupBy("file", "_start").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    before = Window.partitionBy("file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select("file", "_start", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (raw.join(offsets, ["file", "_start"])
            .withColumn("line_no", F.col("_before") + F.col("_id") - F.col("_first"))
            .drop("_start", "_id", "_first", "_before"))


def explode_message_batches(records: DataFrame) -> DataFrame:
    """Per-symbol fetch results -> one row per post (SRC-7, FLT-3, JSN-1).

    A record is the array of messages that the producer publishes, or the
    whole response, of which only those with status 200 count. Empty arrays
    and records that are neither give no row."""
    value = F.ltrim(F.col("value"))
    response = F.from_json(value, MESSAGE_RESPONSE)
    array = F.from_json(value, MESSAGE_RESPONSE["messages"].dataType)
    wrapped = F.when(response["response"]["status"] == 200, response["messages"])
    messages = F.when(F.startswith(value, F.lit("[")), array).otherwise(wrapped)
    posts = records.select(F.explode(messages).alias("m")).where(F.col("m").isNotNull())
    return posts.select(*[F.col("m." + f.name).alias(f.name) for f in POST.fields])


def publish_posts(posts: DataFrame) -> DataFrame:
    """Posts -> ``value`` JSON strings, the message a producer publishes (SNK-8, JSN-2)."""
    return posts.select(F.to_json(F.struct(*[F.col(c) for c in posts.columns])).alias("value"))


def trade_dump_diff(new_lines: DataFrame, old_lines: DataFrame) -> DataFrame:
    """Lines of the new dump absent from the old one, duplicates dropped
    (SET-1, EXCEPT DISTINCT per ticker); the header line present in both
    files drops out here (SET-2)."""
    return new_lines.select("ticker", "line").subtract(old_lines.select("ticker", "line"))


def numbered_dump_diff(new_lines: DataFrame, old_lines: DataFrame) -> DataFrame:
    """``trade_dump_diff`` that keeps ``line_no``, the first one of equal lines:
    one aggregate over both dumps, reduced before its exchange."""
    new = new_lines.select("ticker", "line", "line_no", F.lit(False).alias("_old"))
    old = old_lines.select("ticker", "line", F.lit(None).cast("long").alias("line_no"), F.lit(True).alias("_old"))
    seen = (new.unionByName(old).groupBy("ticker", "line")
            .agg(F.min("line_no").alias("line_no"), F.max("_old").alias("_old")))
    return seen.where(~F.col("_old")).drop("_old")


def normalize_trade_dump(new_lines: DataFrame, old_lines: DataFrame, ingest_epoch: float,
                         with_rejects: bool = False):
    """Vendor dumps -> published trade lines (JOB-8).

    diff -> arity check (8 fields) -> time ``yyyyMMdd'T'HHmmss`` reformatted ->
    ingest stamp and ticker prefixed -> comma-joined ``value`` plus the typed
    10 fields (FLT-4, DAT-7, PRJ-6, STR-5, SNK-9). All tickers in one DataFrame.

    Where the new lines carry ``line_no`` (``number_lines``), a line's stamp is
    the fetch's plus that many microseconds, so trades of one second keep the
    order in which the vendor lists them (Q3).
    """
    numbered = "line_no" in new_lines.columns
    diff = numbered_dump_diff(new_lines, old_lines) if numbered else trade_dump_diff(new_lines, old_lines)
    if numbered:
        micros = F.lit(round(ingest_epoch * 1_000_000)) + F.col("line_no")
        stamp = F.concat_ws(".", F.floor(micros / 1_000_000).cast("string"),
                            F.lpad((micros % 1_000_000).cast("string"), 6, "0"))
    else:
        stamp = F.format_string("%.1f", F.lit(float(ingest_epoch)))
    parts = F.split(F.col("line"), ",")
    good = (F.size(parts) == 8) & (F.col("line") != F.lit(TRADE_DUMP_HEADER))
    checked = diff.withColumn("_p", parts).withColumn("_t", reformat_compact_time(F.element_at("_p", 1)))
    ok = checked.where(good & F.col("_t").isNotNull())
    fields = [stamp.alias("ingest_epoch"), F.col("ticker"),
              F.col("_t").alias("time")] + [F.element_at("_p", i).alias(n) for i, n in
                                            zip(range(2, 9), TRADE_LINE_FIELDS[3:])]
    out = ok.select(*fields)
    out = out.withColumn("value", F.concat_ws(",", *[F.col(n) for n in TRADE_LINE_FIELDS]))
    if with_rejects:
        return out, checked.where(~(good & F.col("_t").isNotNull())).select("ticker", "line")
    return out
