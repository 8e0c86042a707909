import pytest
from pyspark.sql import functions as F

from conftest import make_posts
from tickerlens.operators import bars as B
from tickerlens.operators import mentions as M
from tickerlens.operators import views as V
from tickerlens.sinks import tables as SK
from tickerlens.session import scratch_path, session_conf
from tickerlens.sources import fixtures as FX


def test_live_panel_newest_then_ascending(spark):
    snaps = spark.createDataFrame(
        [(1, 0, "OLD", 99, 1), (2, 0, "A", 9, 1), (2, 1, "B", 4, -2), (2, 2, "C", 4, 0), (2, 3, "D", 7, 3),
         (2, 4, "E", 1, 0)], "timestamp long, id long, ticker string, frequency long, sentiment long")
    rows = V.live_panel(snaps).orderBy("position").collect()
    assert [(r.ticker, r.colour) for r in rows] == [("E", "blue"), ("B", "red"), ("C", "blue"), ("D", "green"),
                                                    ("A", "green")]


def test_trending_at_guards_dst(spark, sf_dir):
    hourly = M.mention_series(FX.posts_from_events(FX.events(spark, sf_dir)), "HR")
    with pytest.raises(ValueError):
        V.trending_at(hourly, "2015_03_08_02")
    with pytest.raises(ValueError):
        V.trending_at(hourly, "2015_11_01_01")
    assert V.trending_at(hourly, "2024_01_02_09").count() <= 10


def test_downsample_preserves_totals(spark, sf_dir):
    minute = M.mention_series(FX.posts_from_events(FX.events(spark, sf_dir)), "MIN")
    total = minute.agg(F.sum("frequency")).first()[0]
    for unit, n in [("minute", 30), ("hour", 4), ("day", 1), ("week", 1), ("month", 6)]:
        assert V.downsample(minute, "MIN", unit, n).agg(F.sum("frequency")).first()[0] == total
    with pytest.raises(ValueError):
        V.downsample(minute, "MIN", "hour", 7)


def test_merge_modes(spark):
    T0, T1 = "Mon Jan 01 10:00:00 +0000 2024", "Mon Jan 01 12:00:00 +0000 2024"
    batch = M.mention_series(make_posts(spark, [(1, T0, "$AA"), (2, T1, "$AA")]), "HR")
    speed = M.mention_series(make_posts(spark, [(3, T1, "$AA $AA"), (4, T1, "$BB")]), "HR")
    cut = {(r.hour, r.ticker, r.frequency) for r in V.merge_views(batch, speed, "HR", "2024-01-01 11:00:00").collect()}
    assert cut == {(10, "AA", 1), (12, "AA", 2), (12, "BB", 1)}
    add = {(r.hour, r.ticker, r.frequency) for r in V.merge_views(batch, speed, "HR", None, "add").collect()}
    assert add == {(10, "AA", 1), (12, "AA", 3), (12, "BB", 1)}
    rep = {(r.hour, r.ticker, r.frequency) for r in V.merge_views(batch, speed, "HR", None, "replace").collect()}
    assert rep == {(10, "AA", 1), (12, "AA", 2), (12, "BB", 1)}


def test_partitioned_sinks_prune(spark, sf_dir):
    posts = FX.posts_from_events(FX.events(spark, sf_dir))
    path = scratch_path(spark, "t_rank")
    SK.write_trending(M.trending(posts, "HR", k=10), path, "HR")
    table = spark.read.parquet(path)
    plan = V.trending_at(table, "2024_01_02_09")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "isnotnull(year" in plan
    spath = scratch_path(spark, "t_series")
    SK.write_series(M.mention_series(posts, "MIN"), spath, "MIN")
    chart = V.mention_chart(spark.read.parquet(spath), "ZZZ")
    assert chart.count() > 0 and chart.where(F.col("ticker") != "ZZZ").count() == 0


def test_repeated_hours_are_told_apart(spark):
    times = {"Sun Nov 03 05:30:00 +0000 2024": "2024_11_03_01-04", "Sun Nov 03 06:30:00 +0000 2024": "2024_11_03_01-05",
             "Sun Nov 03 07:30:00 +0000 2024": "2024_11_03_02", "Sun Nov 03 04:30:00 +0000 2024": "2024_11_03_00",
             "Sun Mar 10 06:30:00 +0000 2024": "2024_03_10_01", "Sun Mar 10 07:30:00 +0000 2024": "2024_03_10_03"}
    hourly = M.mention_series(make_posts(spark, [(i, t, f"${chr(65 + i)}") for i, t in enumerate(times)]), "HR")
    got = {r["ticker"]: r["local_hour"] for r in V.trending_by_local_hour(hourly).collect()}
    assert got == {chr(65 + i): label for i, label in enumerate(times.values())}


def test_colocated_overlay_has_no_exchange(spark, sf_dir):
    """Not for the join, also where it can't broadcast; a hot ticker lies in all buckets."""
    events = FX.events(spark, sf_dir)
    bars, series = B.price_bars(FX.trades_from_events(events), "MIN"), M.mention_series(FX.posts_from_events(events), "MIN")
    name = scratch_path(spark, "axis").rsplit("-", 1)[1]
    b = SK.write_colocated(V.bars_on_axis(bars), f"bars_{name}", scratch_path(spark, "axis_b"), 6)
    s = SK.write_colocated(V.mentions_on_axis(series), f"mentions_{name}", scratch_path(spark, "axis_s"), 6)
    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        plan = V.stored_overlay(b, s)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan and plan.count("Bucketed: true") == 2
    assert len(b.inputFiles()) == 6
    assert s.where(F.col("ticker") == "ZZZ").select(F.input_file_name()).distinct().count() == 6
    want = sorted(map(tuple, V.price_mention_overlay(bars, series).collect()))
    assert sorted(map(tuple, V.stored_overlay(b, s).collect()), key=lambda r: r[:2]) == want
    one = [tuple(r) for r in V.stored_overlay(b, s, "ZZZ").collect()]
    assert one == [r for r in want if r[0] == "ZZZ"]


def test_console_sink(spark, capsys):
    SK.show(spark.createDataFrame([("AA", 1)], "ticker string, frequency int"))
    assert "AA" in capsys.readouterr().out
