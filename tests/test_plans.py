"""Plan-shape checks: the properties the scale design relies on."""

from pyspark.sql import functions as F

from tickerlens.operators import mentions as M
from tickerlens.operators import sliding as SL
from tickerlens.operators import universe as U
from tickerlens.sources import fixtures as FX


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_series_is_one_shuffle_with_partial_agg_and_pruned_scan(spark, sf_dir):
    p = _plan(M.mention_series(FX.posts_from_events(FX.events(spark, sf_dir)), "HR"))
    assert p.count("Exchange hashpartitioning") == 1
    assert "partial_count" in p and "partial_sum" in p
    assert "props" not in p.split("ReadSchema")[1].split("\n")[0]


def test_topk_uses_window_group_limit(spark, sf_dir):
    posts = FX.posts_from_events(FX.events(spark, sf_dir))
    assert "WindowGroupLimit" in _plan(M.trending(posts, "DAY", k=10))
    assert "WindowGroupLimit" in _plan(M.sentiment_extremes(posts, "DAY", 5))
    assert "WindowGroupLimit" in _plan(SL.top_per_window(SL.sliding_counts(posts), 5))


def test_global_top_is_take_ordered(spark, sf_dir):
    posts = FX.posts_from_events(FX.events(spark, sf_dir))
    assert "TakeOrderedAndProject" in _plan(M.global_top(posts, "frequency", 10))


def test_universe_joins_leave_the_choice_to_aqe(spark, sf_dir):
    ev = FX.events(spark, sf_dir)
    universe = FX.universe_from_events(ev)
    for df in (U.posts_in_universe(FX.posts_from_events(ev), U.ticker_universe(universe, ["A"])),
               U.trades_by_exchange(universe, FX.trades_from_events(ev), {"A": "O", "B": "N"})):
        assert "ResolvedHint" not in df._jdf.queryExecution().analyzed().toString()


def test_ranking_and_landing_parse_times_once(spark, sf_dir):
    """No filter of a join on time parts goes down to the scan, where it would parse each post's time again."""
    from tickerlens.streaming.landing import byte_files

    ev = FX.events(spark, sf_dir)
    assert "isnotnull(year" not in _plan(M.trending(FX.posts_from_events(ev), "HR"))
    lines = FX.post_lines(FX.posts_from_events(ev, keep=("ts",)), keep=("ts",))
    plan = _plan(byte_files(lines, F.col("ts"), 0, 5000))
    assert not any("Filter" in x and "lpad" in x for x in plan.splitlines())


def test_arrivals_are_cut_by_the_events_times(spark, sf_dir):
    from tickerlens.plans import catalog

    arrived = [p for p, _ in catalog._spans(spark, sf_dir)]
    assert not any("Filter" in x and "RLIKE" in x for p in arrived for x in _plan(p).splitlines())
    fed = FX.posts_from_events(FX.events(spark, sf_dir)).where("created_at NOT LIKE '____Jan 15 %'")
    assert sum(p.count() for p in arrived) == fed.where(F.substring("created_at", 9, 2) != "15").count()


def test_pane_form_spreads_expansion(spark, sf_dir):
    p = _plan(SL.sliding_counts(FX.posts_from_events(FX.events(spark, sf_dir)), form="pane"))
    assert "REPARTITION_BY_NUM" in p
    assert p.count("Exchange hashpartitioning") == 2  # panes, and blocks of windows; none after the expansion
