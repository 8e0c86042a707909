import json

from pyspark.sql import functions as F

from tickerlens.operators import mentions as M
from tickerlens.operators import sliding as SL
from tickerlens.session import scratch_path
from tickerlens.sinks import tables as SK
from tickerlens.sources import fixtures as FX
from tickerlens.streaming import sources as SS
from tickerlens.streaming import totals as ST
from tickerlens.streaming import trending as STR
from tickerlens.streaming.landing import land_raw


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _staged(spark, sf_dir, n=4, ordered=False):
    df = FX.post_lines(FX.posts_from_events(FX.events(spark, sf_dir)))
    df = df.withColumn("id", F.get_json_object("value", "$.id").cast("long"))
    return FX.stage_files(df, scratch_path(spark, "t_lines"), n, "id", ordered)


def test_stream_totals_equal_batch(spark, sf_dir):
    src = _staged(spark, sf_dir, 4)
    q, table = ST.run_totals(spark, SS.read_post_stream(spark, src, 1), "DAY", scratch_path(spark, "t_tot"),
                             scratch_path(spark, "t_ck"))
    q.awaitTermination()
    batch = M.mention_series(FX.posts_from_events(FX.events(spark, sf_dir)), "DAY")
    assert _same(table.read(), batch)
    assert table.committed() >= 3  # one micro-batch per file


def _post(i, when, text):
    return json.dumps({"id": i, "created_at": when, "text": text})


def _late_feed(spark):
    # Spark judges late rows against the previous batch's watermark, so the
    # late row arrives two micro-batches after the watermark has moved.
    path = scratch_path(spark, "t_late")
    files = [[_post(1, "Mon Jan 01 10:00:00 +0000 2024", "$AA"), _post(2, "Mon Jan 01 11:00:00 +0000 2024", "$AA")],
             [_post(3, "Mon Jan 01 11:30:00 +0000 2024", "$AA")],
             [_post(4, "Mon Jan 01 08:10:00 +0000 2024", "$AA good"), _post(5, "Mon Jan 01 11:40:00 +0000 2024", "$AA")]]
    for rows in files:  # one job per file: modification times follow the feed order
        spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1).write.mode("append").text(path)
    return path


def _late_totals(spark, watermark):
    src = _late_feed(spark)
    q, table = ST.run_totals(spark, SS.read_post_stream(spark, src, 1), "HR", scratch_path(spark, "t_lt"),
                             scratch_path(spark, "t_lck"), watermark=watermark)
    q.awaitTermination()
    return {(r.hour, r.frequency, r.sentiment) for r in table.read().collect()}


def test_late_data_dropped_behind_watermark(spark):
    assert _late_totals(spark, "1 hour") == {(10, 1, 0), (11, 3, 0)}


def test_late_data_counted_without_watermark(spark):
    assert _late_totals(spark, None) == {(8, 1, 1), (10, 1, 0), (11, 3, 0)}


def _trend(spark, arrivals, **options):
    """(snapshots, counts, progress) of the trending stream over arrivals of
    (posts as (time, text), tick times)."""
    src, clock, counts, snaps, ck = (scratch_path(spark, f"t_trend_{x}") for x in ("src", "clock", "counts", "snaps", "ck"))
    progress = []
    for posts, ticks in arrivals:
        lines = [(_post(n, f"Wed Jan 28 {t} +0000 2015", x),) for n, (t, x) in enumerate(posts)]
        spark.createDataFrame(lines, "value string").coalesce(1).write.mode("append").text(src)
        stamps = spark.createDataFrame([(f"2015-01-28 {t}",) for t in ticks], "t string")
        stamps.select(F.to_timestamp("t").alias("ts")).write.mode("append").parquet(clock)
        q = STR.run_top_trending(spark, SS.read_post_stream(spark, src, 1000), counts, snaps, ck, ticks=SS.read_tick_stream(spark, clock), state_partitions=2, **options)
        q.awaitTermination()
        progress += q.recentProgress
    return STR.read_snapshots(spark, snaps), STR.read_counts(spark, counts), progress


def _at(snapshots, time):
    ms = int(snapshots.sparkSession.sql(f"SELECT unix_millis(TIMESTAMP'2015-01-28 {time}')").first()[0])
    return [(r.id, r.ticker, r.frequency) for r in snapshots.where(F.col("timestamp") == ms).orderBy("id").collect()]


def test_snapshots_fade_and_end_while_the_feed_is_quiet(spark):
    first = [("13:00:01", "$AA"), ("13:00:01", "$AA $BB"), ("13:00:03", "$BB $BB $CC")]
    late = [("12:59:00", "$DD $DD $DD $DD"), ("13:40:00", "$EE")]
    ticks = [["13:00:10"], ["13:05:00", "13:11:00"], ["13:20:00", "13:30:00"], ["13:40:30"]]
    snaps, counts, _ = _trend(spark, [(first, ticks[0]), ([], ticks[1]), ([], ticks[2]), (late, ticks[3])])
    assert snaps.groupBy("timestamp", "id").count().where("count > 1").count() == 0
    full = [(0, "BB", 3), (1, "AA", 2), (2, "CC", 1)]
    assert _at(snaps, "13:00:05") == full and _at(snaps, "13:10:00") == full  # the window still holds them
    assert _at(snaps, "13:10:05") == [(0, None, 0)]  # and no longer
    assert _at(snaps, "13:25:00") == [(0, None, 0)] and _at(snaps, "13:40:05") == [(0, "EE", 1)]
    assert snaps.where("ticker = 'DD'").count() == 0 and counts.where("ticker = 'DD'").count() == 0  # late by far
    assert counts.where("ticker = ''").count() == 0


def test_trending_state_and_reads_stay_flat(spark):
    """Fifty batches of a minute each: state rows and written files per batch don't grow."""
    src, clock, counts, snaps, ck = (scratch_path(spark, f"t_flat_{x}") for x in ("src", "clock", "counts", "snaps", "ck"))
    for i in range(50):
        line = _post(i, f"Wed Jan 28 13:{i:02d}:30 +0000 2015", "$AA $BB")
        spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("append").text(src)
    spark.createDataFrame([], "ts timestamp").write.parquet(clock)
    q = STR.run_top_trending(spark, SS.read_post_stream(spark, src, 1), counts, snaps, ck, window="2 minutes", slide="30 seconds",
                             ticks=SS.read_tick_stream(spark, clock), state_partitions=1)
    q.awaitTermination()
    batches = [p for p in q.recentProgress if p["numInputRows"]]
    states = [[o["numRowsTotal"] for o in p["stateOperators"]] for p in batches]
    assert len(states) >= 50 and max(map(sum, states[10:])) == max(map(sum, states[3:10]))
    rows = STR.read_snapshots(spark, snaps)
    assert rows.count() == 2 * rows.select("timestamp").distinct().count() >= 180


def test_sliding_counts_of_both_streams_equal_batch(spark, sf_dir):
    src = _staged(spark, sf_dir, 3)
    q, table = STR.run_sliding_counts(spark, SS.read_post_stream(spark, src, 1), scratch_path(spark, "t_sl"), scratch_path(spark, "t_slck"), slide="60 seconds")
    q.awaitTermination()
    batch = SL.sliding_counts(FX.posts_from_events(FX.events(spark, sf_dir)), slide="60 seconds")
    assert _same(table.read(), batch)


def _table(spark):
    return SK.BlockTable(spark, scratch_path(spark, "t_bt"), ["day", "k"], F.col("day"), spark.createDataFrame([], "day int, k int, v long").schema)


def _rows(spark, *rows):
    return spark.createDataFrame(rows, "day int, k int, v long")


def _read(table):
    return sorted(tuple(r) for r in table.read().collect())


def test_block_table_replay_is_idempotent(spark):
    table = _table(spark)
    assert _read(table) == [] and table.committed() == -1
    table.merge(_rows(spark, (1, 1, 10), (2, 1, 20)), 0, add=True)
    for _ in range(3):  # replays add to the state before the batch
        table.merge(_rows(spark, (1, 1, 5), (1, 2, 7)), 1, add=True)
    assert _read(table) == [(1, 1, 15), (1, 2, 7), (2, 1, 20)]
    table.merge(_rows(spark, (2, 1, 1)), 2)
    assert _read(table) == [(1, 1, 15), (1, 2, 7), (2, 1, 1)] and table.committed() == 2
    assert sorted(tuple(r) for r in table.read(("2", "2")).collect()) == [(2, 1, 1)]


def test_block_table_does_not_read_a_lost_commit(spark):
    table = _table(spark)
    table.merge(_rows(spark, (1, 1, 10)), 0, add=True)
    lost = _rows(spark, (1, 1, 5), (2, 2, 5))
    table._rewrite(lost.withColumn("block", F.col("day").cast("string")), ["1", "2"], 1, True)  # written, but the mark is lost
    assert _read(table) == [(1, 1, 10)] and table.committed() == 0
    table.merge(lost, 1, add=True)
    assert _read(table) == [(1, 1, 15), (2, 2, 5)]


def test_block_table_files_do_not_grow(spark):
    table = _table(spark)
    for i in range(12):
        table.merge(_rows(spark, (1, i, i), (2 if i < 3 else 1, 100 + i, i)), i)
    files = spark.read.schema(table.schema).parquet(table.data).inputFiles()
    assert len(files) <= 4 and len(_read(table)) == 24


def test_calendar_buckets_behind_a_watermark(spark):
    """Months leave the state when their end is behind the watermark, not when the next begins."""
    src = scratch_path(spark, "t_months")
    for day in ("Wed Jan 28", "Sun Feb 01", "Fri Jan 30", "Sun Mar 15", "Mon Mar 16", "Tue Jan 27", "Sat Feb 07"):
        spark.createDataFrame([(_post(1, f"{day} 10:00:00 +0000 2015", "$AA"),)], "value string").coalesce(1).write.mode("append").text(src)
    for grain, want in (("MONTH", {(1, 2), (2, 1), (3, 2)}), ("YEAR", {(None, 7)})):
        q, table = ST.run_totals(spark, SS.read_post_stream(spark, src, 1), grain, scratch_path(spark, "t_mt"), scratch_path(spark, "t_mck"), watermark="5 days", state_partitions=2)
        q.awaitTermination()
        got = {(r.month if grain == "MONTH" else None, r.frequency) for r in table.read().collect()}
        assert got == want
        states = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
        assert states[-1] == 1 and max(states) == (3 if grain == "MONTH" else 1)


def test_partitioned_sinks_write_few_files(spark, sf_dir):
    from tickerlens.sinks import tables as SK

    series = M.mention_series(FX.posts_from_events(FX.events(spark, sf_dir)), "HR")
    path = scratch_path(spark, "t_files")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        SK.write_series(series, path, "HR")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = len(spark.read.parquet(path).inputFiles())
    assert files <= series.select("ticker", "year", "month").distinct().count()


def test_series_folders_do_not_follow_the_tickers(spark, tmp_path):
    from tickerlens.sinks import tables as SK

    series = spark.range(2000).select(
        F.lit(2024).alias("year"), F.lit(1).alias("month"), F.lit(1).alias("day"), F.lit(0).alias("hour"),
        FX.ticker_of(F.col("id")).alias("ticker"), F.lit(1).cast("long").alias("frequency"), F.lit(0).cast("long").alias("sentiment"))
    SK.write_series(series, f"{tmp_path}/series", "HR")
    stored = spark.read.parquet(f"{tmp_path}/series")
    assert len(stored.inputFiles()) <= SK.SLICES and _same(stored.select(*series.columns), series)
    one = stored.where((F.col("slice") == SK.ticker_slice(F.lit("AAB"))) & (F.col("ticker") == "AAB"))
    assert one.count() == 1


def test_landed_files_are_listed_by_few_tasks(spark, tmp_path):
    from tickerlens.streaming.landing import byte_files, read_byte_files, write_byte_files

    rows = [(f"{i:04d}" + "x" * 95, "2024-01-05 10:00:00") for i in range(400)] + [("lost", None)]
    lines = spark.createDataFrame(rows, "value string, at string")
    write_byte_files(byte_files(lines, F.col("at").cast("timestamp_ntz"), 15, max_bytes=400), f"{tmp_path}/l")
    before = spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism", None)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("listing", "listing")
    try:
        back = read_byte_files(spark, f"{tmp_path}/l")
        jobs = tracker.getJobIdsForGroup("listing")
        tasks = [tracker.getStageInfo(s).numTasks for j in jobs for s in tracker.getJobInfo(j).stageIds]
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert tasks and max(tasks) <= 4 * spark.sparkContext.defaultParallelism
    assert back.select("file").distinct().count() == 100 and back.count() == 400
    assert spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism", None) == before


def test_landing_rolls_files(spark, sf_dir):
    src = _staged(spark, sf_dir, 2)
    out = scratch_path(spark, "t_land")
    q = land_raw(spark.readStream.format("text").load(src), out, scratch_path(spark, "t_landck"), 15, 200)
    q.awaitTermination()
    landed = spark.read.text(out)
    assert landed.count() == 1000 and "block" in landed.columns
    assert len(spark.read.text(out).inputFiles()) >= 5  # 1,000 lines at 200 per file


def test_state_partitions_do_not_leak(spark, sf_dir):
    src = _staged(spark, sf_dir, 2)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    q, _ = ST.run_totals(spark, SS.read_post_stream(spark, src, 1), "DAY", scratch_path(spark, "t_sp"),
                           scratch_path(spark, "t_spck"), state_partitions=3)
    q.awaitTermination()
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert q.lastProgress["stateOperators"][0]["numShufflePartitions"] == 3


def test_landed_files_roll_by_bytes(spark, tmp_path):
    from tickerlens.streaming.landing import byte_files, write_byte_files

    rows = [(f"line {i} " + "x" * (i % 37), f"2024-01-05 10:{(i // 40) % 60:02d}:0{i % 3}") for i in range(3000)]
    rows += [(None, "2024-01-05 10:00:00"), ("", "2024-01-05 10:00:00"), ("same", "2024-01-05 10:00:00")]
    lines = spark.createDataFrame(rows, "value string, at string").withColumn("at", F.col("at").cast("timestamp_ntz"))
    path = f"{tmp_path}/landed"
    write_byte_files(byte_files(lines, F.col("at"), 15, max_bytes=4000), path)
    back = spark.read.schema("value string, file string").text(path)
    assert sorted(r.value for r in back.collect()) == sorted(v or "" for v, _ in rows)
    sizes = {r.file: r.n for r in back.groupBy("file").agg(F.sum(F.octet_length("value") + 1).alias("n")).collect()}
    blocks = {}
    for name, n in sizes.items():
        block, number = name.split("_")
        blocks.setdefault(block, {})[int(number)] = n
    assert len(blocks) == 4
    for block, files in blocks.items():
        assert sorted(files) == list(range(len(files)))
        assert all(4000 - 60 <= files[n] <= 4000 + 60 for n in range(len(files) - 1))
    for folder in (tmp_path / "landed").glob("file=*"):
        assert len(list(folder.glob("*.txt"))) == 1


def test_stream_landing_by_bytes_replays_a_batch(spark, tmp_path):
    from tickerlens.streaming.landing import land_by_bytes

    (tmp_path / "in").mkdir()
    for i in range(3):
        (tmp_path / "in" / f"{i}.txt").write_text("\n".join(f"{i}-{j}" for j in range(200)) + "\n")

    def run(checkpoint):
        lines = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(f"{tmp_path}/in")
        land_by_bytes(lines, f"{tmp_path}/out", f"{tmp_path}/{checkpoint}", max_bytes=300,
                      state_partitions=4).awaitTermination()
        return sorted(r.value for r in spark.read.text(f"{tmp_path}/out").collect())

    want = sorted(f"{i}-{j}" for i in range(3) for j in range(200))
    assert run("c1") == want
    assert run("c2") == want  # every batch once more, as after a lost commit


def test_runs_hold_far_fewer_rows_than_windows(spark, sf_dir):
    """Counts of sliding windows are made, ranked and stored as runs, and no window is unfolded before."""
    posts = FX.posts_from_events(FX.events(spark, sf_dir))
    runs, counts = SL.sliding_runs(posts), SL.sliding_counts(posts)
    assert runs.count() * 40 < counts.count()
    assert _same(SL.top_of_runs(runs, k=3), SL.top_per_window(counts, 3))
    short = {"window": "70 seconds", "slide": "10 seconds"}  # seven panes; blocks that cut runs
    cut, plain = SL.sliding_runs(posts, **short, block_panes=9), SL.sliding_counts(posts, **short, form="plain")
    assert _same(SL.unfold_runs(cut, "10 seconds"), plain) and _same(SL.top_of_runs(cut, **short, k=2), SL.top_per_window(plain, 2))


def test_trending_state_holds_panes_not_windows(spark):
    posts = [(f"13:{m:02d}:{s:02d}", f"$A{chr(65 + m)}") for m in range(20) for s in range(0, 60, 5)]
    _, counts, progress = _trend(spark, [(posts, ["13:00:00"]), ([], ["14:00:00"])])
    states = [o["numRowsTotal"] for p in progress for o in p["stateOperators"]]
    assert max(states) <= 400  # 240 panes and their windows' ends; one row a ticker and window were thousands
    assert counts.count() == 20 * (120 + 11) and counts.where("frequency = 12").count() == 20 * 109


def test_running_table_stores_panes(spark, sf_dir):
    src = _staged(spark, sf_dir, 2)
    path = scratch_path(spark, "t_wt")
    q, table = STR.run_sliding_counts(spark, SS.read_post_stream(spark, src, 1), path, scratch_path(spark, "t_wtck"))
    q.awaitTermination()
    batch = SL.sliding_counts(FX.posts_from_events(FX.events(spark, sf_dir)))
    stored = spark.read.parquet(f"{path}/data")
    assert stored.groupBy("gen").count().agg(F.max("count")).first()[0] * 40 < batch.count()
    day = F.floor(F.col("window_end_ms") / STR.BLOCK_MS)
    assert _same(table.read(("019725", "019726")), batch.where(day.between(19725, 19726)))
