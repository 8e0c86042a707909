from pyspark.sql import functions as F

from conftest import make_posts
from tickerlens.functions import text as X
from tickerlens.operators import mentions as M

T0 = "Wed Jan 28 13:08:45 +0000 2015"


def test_golden_cashtags_and_score(spark):
    df = spark.createDataFrame([("$AAPL buy_now $GOOGl good! $Apple $BRK.B $fb",)], "t string")
    r = df.select(X.cashtags("t").alias("c"), X.tickers("t").alias("k"), X.post_score("t").alias("s")).first()
    assert r.c == ["$AAPL", "$GOOG", "$A", "$BRK"]
    assert r.k == ["AAPL", "GOOG", "A", "BRK"]
    assert r.s == 1  # buy_now is one token (no score); good +1


def test_ticker_letters_are_tokens(spark):
    df = spark.createDataFrame([("$WIN",), ("café long",), ("short, SHORT and down 5sell",)], "t string")
    # "5sell" splits on the digit: "sell" still scores
    assert [r.s for r in df.select(X.post_score("t").alias("s")).collect()] == [1, 1, -4]


def test_empty_and_tagless_posts_give_no_rows(spark):
    posts = make_posts(spark, [(1, T0, ""), (2, T0, "no tickers here, good"), (3, T0, "$WIN")])
    rows = M.mention_series(posts, "HR").collect()
    assert [(r.ticker, r.frequency, r.sentiment) for r in rows] == [("WIN", 1, 1)]


def test_repeated_mentions_count_each(spark):
    posts = make_posts(spark, [(1, T0, "$AB good $AB"), (2, T0, "$AB sell")])
    r = M.mention_series(posts, "DAY").collect()
    assert len(r) == 1 and r[0].frequency == 3 and r[0].sentiment == 1 * 2 + (-1)


def test_colour_sign_importance(spark):
    df = spark.createDataFrame([(3, 100, 20), (-2, 5, 5), (0, 7, 11)], "s int, fo int, fr int")
    rows = df.select(X.colour("s").alias("c"), X.sentiment_sign("s").alias("g"),
                     X.author_importance("fo", "fr").alias("i")).collect()
    assert [(r.c, r.g) for r in rows] == [("green", 1), ("red", -1), ("blue", 0)]
    assert [r.i for r in rows] == [5.0, 1.0, 7 / 11]


def test_json_decoding_exposes_words(spark):
    # The raw text is decoded before tokenising: "\nlong" is the word "long" (+1).
    from tickerlens.sources.readers import parse_posts

    line = '{"id": 1, "created_at": "%s", "text": "$AB\\nlong", "user": {"followers_count": 1}}' % T0
    posts = parse_posts(spark.createDataFrame([(line,)], "value string"))
    assert M.mention_series(posts, "HR").first().sentiment == 1


def test_lexicon_table_join_equals_inline_form(spark, sf_dir):
    from tickerlens.functions.lexicon import DEFAULT_LEXICON
    from tickerlens.sources import fixtures as FX

    posts = FX.posts_from_events(FX.events(spark, sf_dir))
    # Above the old bound on words, and with a repeated word.
    table = DEFAULT_LEXICON.as_dataframe(spark)
    table = table.unionByName(table.limit(3)).unionByName(spark.range(150_000).select(
        F.concat(F.lit("zz"), F.col("id").cast("string")).alias("word"), F.lit(1).alias("polarity")))
    a, b = M.mention_series(posts, "DAY"), M.mention_series_with_lexicon(posts, "DAY", table)
    b = b.select(*a.columns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_large_inline_lexicon():
    from tickerlens.functions.lexicon import Lexicon

    assert len(Lexicon(tuple(f"w{i}" for i in range(120_000)), ()).positive) == 120_000


def test_malformed_times_are_rejects_not_failures(spark):
    from tickerlens.functions.timefn import parse_local_time, parse_post_time, reformat_compact_time

    posts = make_posts(spark, [(1, "Wed Jan 28 13:08:45 +0000 2015", "$AA"), (2, "garbage", "$AA"),
                               (3, "Wed Foo 28 13:08:45 +0000 2015", "$AA"), (4, "Wed Feb 31 10:00:00 +0000 2015", "$AA"),
                               (5, "wed JAN 28 13:59:59 +0000 2015", "$AA good")])
    r = M.mention_series(posts, "HR").collect()
    assert [(x.hour, x.frequency, x.sentiment) for x in r] == [(13, 2, 1)]
    df = spark.createDataFrame([("2015-02-02 15:30:01",), ("2015-13-02 15:30:01",), ("x",)], "s string")
    assert [x[0] is None for x in df.select(parse_local_time("s")).collect()] == [False, True, True]
    c = spark.createDataFrame([("20150202T153001",), ("2015020T153001",)], "s string")
    assert [x[0] for x in c.select(reformat_compact_time("s")).collect()] == ["2015-02-02 15:30:01", None]
    assert spark.range(1).select(parse_post_time(F.lit(None).cast("string"))).first()[0] is None
