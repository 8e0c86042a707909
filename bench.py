"""Benchmark of the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` and prints one JSON line. Batch queries are run to
completion through the ``noop`` sink (no collect); the reported time is the
warm median of ``$BENCH_REPEAT`` runs (default 3) after one warm-up run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tickerlens.session import build_session  # noqa: E402


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus))

    from tickerlens.operators import bars, mentions, sliding
    from tickerlens.plans import catalog
    from tickerlens.sources import fixtures

    from tickerlens.session import scratch_path
    from tickerlens.sources import readers

    # The feeds are staged once, as several files, outside the timing: what is
    # timed is the library's work, not the fixture that makes posts and trades.
    ev = fixtures.events(spark, sf_dir)
    posts_path, trades_path = scratch_path(spark, "bench_posts"), scratch_path(spark, "bench_trades")
    fixtures.posts_from_events(ev).repartition(int(cpus), "id").write.parquet(posts_path)
    fixtures.trades_from_events(ev).repartition(int(cpus), "seq").write.parquet(trades_path)
    posts, trades = spark.read.parquet(posts_path), spark.read.parquet(trades_path)

    batch = {
        "mention_series_hr": lambda: mentions.mention_series(posts, "HR"),
        "mention_series_week": lambda: mentions.mention_series(posts, "WEEK"),
        "bars_min": lambda: bars.price_bars(trades, "MIN"),
        "top10_per_day": lambda: mentions.trending(posts, "DAY", k=10),
        "sentiment_top5_positive": lambda: mentions.sentiment_extremes(posts, "DAY", 5),
        "sliding_top5_pane": lambda: sliding.top_per_window(sliding.sliding_counts(posts, form="pane"), 5),
        "sliding_top5_plain": lambda: sliding.top_per_window(sliding.sliding_counts(posts, form="plain"), 5),
    }
    # Production read path: the same posts as JSON-line files (staged once,
    # not timed) read through the JSON data source.
    json_path = scratch_path(spark, "bench_post_lines")
    fixtures.post_lines(posts).write.mode("overwrite").text(json_path)
    batch["mention_series_hr_from_json"] = lambda: mentions.mention_series(readers.read_posts(spark, json_path), "HR")

    results = {}
    for name, build in batch.items():
        build().write.format("noop").mode("overwrite").save()  # warm-up
        times = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - t0)
        results[name] = round(statistics.median(times), 3)

    # Streaming totals: the posts are staged as 8 JSON-line files (producer
    # side, not timed); the stream then drains them one file per trigger
    # (available-now) into the keyed log, and the log is read back.
    src = catalog._staged_posts(spark, sf_dir, 8)
    t0 = time.perf_counter()
    catalog._stream_totals(spark, sf_dir, src=src).write.format("noop").mode("overwrite").save()
    results["stream_totals_8_files"] = round(time.perf_counter() - t0, 3)

    sf = os.path.basename(sf_dir).replace("sf", "")
    try:
        sf = float(sf)
    except ValueError:
        pass
    print(json.dumps({"metric": "headline_total", "value": round(sum(results.values()), 3), "unit": "sec",
                      "queries": results, "sf": sf, "cpus": int(cpus), "repeat": repeat}))


if __name__ == "__main__":
    main()
