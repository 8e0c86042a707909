import pytest
from pyspark.sql import functions as F

from tickerlens.operators import universe as U
from tickerlens.sources import fixtures as FX
from tickerlens.sources import readers as R

T0 = "Wed Jan 28 13:08:45 +0000 2015"


def test_permissive_posts_and_rejects(spark):
    lines = spark.createDataFrame([('{"id": 1, "created_at": "%s", "text": "$AB"}' % T0,), ("{broken",),
                                   ('{"id": 2, "created_at": "%s"}' % T0,)], "value string")
    good, bad = R.parse_posts(lines, with_rejects=True)
    assert [r.id for r in good.collect()] == [1]
    assert [r.value for r in bad.collect()] == ["{broken"]


def test_trade_lines_skip_empty_and_trim(spark):
    lines = spark.createDataFrame([("1.0, AB ,2015-02-02 15:30:01, 99.5 ,10,b,s,,,",), ("",),
                                   ("2.0,AB,2015-02-02 15:30:02,oops,1,b,s,,,",)], "value string")
    rows = R.parse_trade_lines(lines).collect()
    assert len(rows) == 2 and rows[0].ticker == "AB" and rows[0].price == 99.5 and rows[1].price is None


def test_dump_normalisation_rejects_bad_arity(spark):
    new = spark.createDataFrame([("X", "time,price,quantity,board,source,buyer,seller,initiator"),
                                 ("X", "20150202T153001,99.5,10,b,s,,,"), ("X", "20150202T153002,1,2"),
                                 ("X", "20150202T153003,100,1,b,s,,,")], "ticker string, line string")
    old = spark.createDataFrame([("X", "time,price,quantity,board,source,buyer,seller,initiator"),
                                 ("X", "20150202T153003,100,1,b,s,,,")], "ticker string, line string")
    out, rej = R.normalize_trade_dump(new, old, 1422888600.0, with_rejects=True)
    assert [r.value for r in out.collect()] == ["1422888600.0,X,2015-02-02 15:30:01,99.5,10,b,s,,,"]
    assert [r.line for r in rej.collect()] == ["20150202T153002,1,2"]


def test_universe_unknown_list_raises(spark, sf_dir):
    u = FX.universe_from_events(FX.events(spark, sf_dir))
    with pytest.raises(ValueError):
        U.ticker_universe(u, ["A", "NOPE"])
    tags = U.ticker_universe(u, ["A"])
    assert tags.where(~F.col("cashtag").startswith("$")).count() == 0


def test_posts_in_universe_needs_no_key(spark):
    posts = spark.createDataFrame([(1, "$AA $BB $AA"), (1, "$ZZ"), (None, "$AA"), (None, "$AA"), (2, "none")],
                                  "id long, text string")
    for n in (1, 60_000):  # also above the old bound
        tags = spark.range(n).select(F.concat(F.lit("$X"), F.col("id").cast("string")).alias("cashtag"))
        tags = tags.unionByName(spark.createDataFrame([("$AA",), ("$BB",)], "cashtag string"))
        rows = U.posts_in_universe(posts, tags).collect()
        assert sorted(map(tuple, rows), key=repr) == [(1, "$AA $BB $AA"), (None, "$AA"), (None, "$AA")]


def test_track_list_has_no_cap_and_can_be_dealt_out(spark):
    tags = spark.range(1_000_500).select(F.concat(F.lit("$"), F.col("id").cast("string")).alias("cashtag"))
    lists = U.track_list(tags, chunks=16).collect()
    assert len(lists) == 16 and sum(r["track"].count(",") + 1 for r in lists) == 1_000_500


def test_malformed_trade_lines(spark):
    lines = spark.createDataFrame([("garbage",), ("",), ("1.0,AB,2015-02-02 15:30:01,99.5,10",), ("2.0,AB,oops,1,1,b,s,,,",),
                                   ("3.0,AB,2015-02-02 15:30:02,x,1,b,s,,,",), ("4.0, ,2015-02-02 15:30:02,1,1",)], "value string")
    good, bad = R.parse_trade_lines(lines, with_rejects=True)
    assert [(r.ticker, r.price, r.quantity, r.board) for r in good.collect()] == [("AB", 99.5, 10.0, None)]
    assert sorted(r.value[:3] for r in bad.collect()) == ["2.0", "3.0", "4.0", "gar"]
    from tickerlens.operators import bars as B
    assert B.price_bars(R.trades_from_lines(lines), "MIN").where("year is null").count() == 0


def test_message_batches_keep_status_200(spark):
    ok = '{"response": {"status": 200}, "messages": [{"id": 1, "text": "$AB"}, {"id": 2, "text": "$CD"}]}'
    bad = '{"response": {"status": 429}, "messages": [{"id": 3, "text": "$EF"}]}'
    empty = '{"response": {"status": 200}, "messages": []}'
    bare = ' [{"id": 5, "text": "$AB"}, {"id": 6}, null]'
    df = spark.createDataFrame([(ok,), (bad,), (empty,), (bare,), ("[]",), ("{x",), (None,)], "value string")
    assert sorted(r.id for r in R.explode_message_batches(df).collect()) == [1, 2, 5, 6]


def test_universe_layouts_and_dump_files(spark, tmp_path):
    (tmp_path / "u.csv").write_text("Ticker,Code,Name\n AB ,GOOG/NYSE_AB,Ab Inc\n")
    (tmp_path / "all.csv").write_text("GOOG/NYSE_CD,Cd Inc\nGOOG/NASDAQ_EF,Ef Inc\n")
    assert [r.Ticker for r in R.read_universe(spark, f"{tmp_path}/u.csv", "A").collect()] == ["AB"]
    assert sorted(r.Ticker for r in R.read_universe(spark, f"{tmp_path}/all.csv", "ALL", "all").collect()) == ["CD", "EF"]
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "ABNew.csv").write_text("h\nx\n")
    (tmp_path / "d" / "ABOld.csv").write_text("h\n")
    new, old = (R.read_trade_dumps(spark, f"{tmp_path}/d", s) for s in ("New", "Old"))
    assert [tuple(r) for r in R.trade_dump_diff(new, old).collect()] == [("AB", "x")]


def test_message_batches_are_bounded(spark, sf_dir):
    recs = FX.message_batches_from_posts(FX.posts_from_events(FX.events(spark, sf_dir)))
    sizes = recs.select(F.size(F.from_json("value", "messages array<string>").getField("messages")).alias("n"))
    assert sizes.agg(F.max("n")).first()[0] <= FX.MESSAGES_PER_FETCH


def test_trade_files_csv_equal_line_parse(spark, sf_dir):
    from tickerlens.session import scratch_path

    lines = FX.trade_lines_from_events(FX.events(spark, sf_dir))
    path = scratch_path(spark, "t_trades")
    lines.write.mode("overwrite").text(path)
    a = R.read_trades(spark, path)
    b = R.trades_from_lines(spark.read.text(path))
    assert a.count() == 1000 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_tagged_posts_in_one_scan(spark, tmp_path):
    good = '{"id": 1, "created_at": "%s", "text": "$AB"}' % T0
    lines = spark.createDataFrame([(good,), ("{broken",), ('{"id": "x", "created_at": "%s", "text": "a"}' % T0,), ("  ",),
                                   ('{"id": 2, "created_at": "%s"}' % T0,), ('{"id": 3, "created_at": "noon", "text": ""}',),
                                   ('{"id": 4, "text": "no time"}',), (None,), (good,)], "value string")
    lines.write.text(f"{tmp_path}/in")
    tagged = R.tag_posts(spark.read.text(f"{tmp_path}/in"))
    assert R.write_tagged(tagged, f"{tmp_path}/out") == {"json": 2, "text": 1, "time": 2, "good": 2}
    out = spark.read.parquet(f"{tmp_path}/out")
    rows = sorted((r.status, r.id) for r in out.where("status <> 'json'").collect())
    assert rows == [("good", 1), ("good", 1), ("text", 2), ("time", 3), ("time", 4)]
    assert out.where("status = 'good' AND value IS NULL").count() == 2
    assert {r.value for r in out.where("status = 'json'").collect()} >= {"{broken"}
    plan = tagged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_line_numbers_across_splits(spark, tmp_path):
    import random

    rng = random.Random(5)
    files = {n: ["".join(rng.choices("abc", k=rng.randrange(0, 40))) for _ in range(500)] for n in ("A", "B")}
    for n, rows in files.items():
        (tmp_path / f"{n}.csv").write_text("\n".join(rows) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "997b")
    try:
        got = R.number_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    for n, rows in files.items():
        mine = sorted((r.line_no, r.value) for r in got if r.file.endswith(f"{n}.csv"))
        assert mine == list(enumerate(rows))


def test_numbered_dump_keeps_arrival_order(spark):
    from tickerlens.operators.bars import price_bars

    line = "20240105T100000,%s,1.0,b,s,,,"
    new = spark.createDataFrame([("AB", line % p, n) for n, p in enumerate((5.0, 9.0, 3.0, 9.0, 4.0))]
                                + [("AB", "20240105T100000,7.0,1.0", 9)], "ticker string, line string, line_no long")
    old = spark.createDataFrame([("AB", line % 5.0)], "ticker string, line string")
    out, bad = R.normalize_trade_dump(new, old, 1704067200.0, with_rejects=True)
    assert [r.line for r in bad.collect()] == ["20240105T100000,7.0,1.0"]
    assert sorted(r.ingest_epoch for r in out.collect()) == ["1704067200.000001", "1704067200.000002", "1704067200.000004"]
    bar = price_bars(R.trades_from_lines(out), "HR").collect()
    assert [(b.open, b.high, b.low, b.close) for b in bar] == [(9.0, 9.0, 3.0, 4.0)]


@pytest.mark.parametrize("n", [0, 10, 60_000, 1_000_000])
def test_sketched_universe_equals_exact_join(spark, n):
    letter = lambda c, d: F.char((F.lit(65) + F.floor(c / d) % 26).cast("long"))
    word = lambda c: F.concat(F.lit("$"), *[letter(c, 26 ** i) for i in range(5)])
    tags = spark.range(n).select(word(F.col("id") * 7).alias("cashtag"))
    posts = spark.range(0, 3000).select(
        (F.col("id") % 50).alias("id"), F.when(F.col("id") % 11 != 0, F.concat(
            word(F.col("id") * 13 % 9000), F.lit(" and "), word(F.col("id") * 977), F.lit(" $"))).alias("text"),
        F.lit(None).cast("string").alias("likely"))
    named = posts.where(F.col("text").isNotNull()).select(
        "id", "text", F.explode(F.regexp_extract_all("text", F.lit(r"\$[A-Z]+"), 0)).alias("cashtag"))
    want = {tuple(r) for r in named.join(tags, "cashtag", "left_semi").select("id", "text").collect()}
    got = U.posts_in_universe(posts, tags)
    assert got.columns == ["id", "text", "likely"]
    rows = [(r.id, r.text) for r in got.collect()]
    all_rows = [(r.id, r.text) for r in posts.collect()]
    assert sorted(rows) == sorted(r for r in all_rows if r in want)
    assert (n == 0) == (not rows)
