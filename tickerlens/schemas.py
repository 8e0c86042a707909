"""Explicit schemas of the feeds and serving tables (no inference at scans)."""

from pyspark.sql import types as T

USER = T.StructType([
    T.StructField("followers_count", T.IntegerType()),
    T.StructField("friends_count", T.IntegerType()),
    T.StructField("description", T.StringType()),
    T.StructField("name", T.StringType()),
])

# One post as it arrives on the feed (JSON line).
POST = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("user", USER),
])

POST_WITH_CORRUPT = T.StructType(POST.fields + [T.StructField("_corrupt_record", T.StringType())])

# A trade line: positional comma fields, all text on the wire.
TRADE_LINE_FIELDS = ("ingest_epoch", "ticker", "time", "price", "quantity",
                     "board", "source", "buyer", "seller", "initiator")

# Typed trades used by the bar operators; ``time`` is the venue's local wall clock.
TRADE = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("time", T.TimestampNTZType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("quantity", T.DoubleType()),
    T.StructField("seq", T.LongType()),
])

# Vendor trade dump: header plus 8 comma fields per line.
TRADE_DUMP_HEADER = "time,price,quantity,board,source,buyer,seller,initiator"

# Backup minute bars: no header, epoch seconds first.
BACKUP_BAR = T.StructType([
    T.StructField("epoch", T.LongType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
])

UNIVERSE = T.StructType([
    T.StructField("Ticker", T.StringType()),
    T.StructField("Code", T.StringType()),
    T.StructField("Name", T.StringType()),
])

# Per-symbol message fetch: status plus a JSON array of posts.
MESSAGE_RESPONSE = T.StructType([
    T.StructField("response", T.StructType([T.StructField("status", T.IntegerType())])),
    T.StructField("messages", T.ArrayType(POST)),
])

SNAPSHOT = T.StructType([
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("id", T.LongType()),
    T.StructField("ticker", T.StringType()),
    T.StructField("frequency", T.LongType()),
    T.StructField("sentiment", T.LongType()),
])
