"""Sliding-window trending on a stream (JOB-5, STM-4..7).

One query sums occurrences into panes of one slide, and tells which windows
have ended; both append what the watermark has passed. A batch joins its panes
to those that the batch before has left for it, the last window's worth, and
computes the windows that have ended, whole, with all their tickers, as runs
(``operators.sliding``). So a pane is in the state once, not once for each of
its windows. State and work follow the span between the newest event and the
watermark, not the uptime.

``ticks`` drive time where no posts do: a tick is an occurrence of no ticker
that counts nothing. Windows end and old counts fade while the feed is quiet,
and a window that holds ticks alone gives an empty snapshot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickerlens.functions.lexicon import DEFAULT_LEXICON, Lexicon
from tickerlens.functions.timefn import instant_wall_clock, wall_clock_instant
from tickerlens.operators.sliding import RUNS, _seconds, occurrences_at_time, pane_index, runs_of_panes, top_of_runs, unfold_runs
from tickerlens.session import start_stream
from tickerlens.sinks.tables import BlockTable, make_folder, write_batch

#: Counts are stored as runs of windows, whose ends are ``step_ms`` apart.
COUNTS = f"{RUNS}, step_ms long"
PANES = "ticker string, pane long, n long, sc long"
SNAPSHOTS = "timestamp long, id long, ticker string, frequency long, sentiment long, written_at timestamp"
#: Counts and snapshots are stored by the day in which their window ends.
BLOCK_MS = 86_400_000
NO_TICKER = ""


def clock_ticks(spark: SparkSession, every_seconds: int = 5) -> DataFrame:
    """A tick every few seconds by the clock (DAT-14), to union with a live feed."""
    beats = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return beats.where(F.col("value") % every_seconds == 0).select(F.col("timestamp").alias("ts"))


def stream_panes(posts: DataFrame, window: str = "10 minutes", slide: str = "5 seconds",
                 watermark: str = "10 seconds", ticks: DataFrame | None = None,
                 lexicon: Lexicon = DEFAULT_LEXICON) -> DataFrame:
    """``PANES`` once the watermark has passed their end (append mode), ticks
    under the empty ticker, which count 0. Posts later than the watermark
    allows are left out. Rows of a null ticker are windows that have ended and
    hold a pane: their ``pane`` is the last one in it."""
    if _seconds(window) % _seconds(slide):
        raise ValueError("window must be a multiple of slide")
    rows = occurrences_at_time(posts, lexicon).select(
        wall_clock_instant(F.col("ts")).alias("ts"), "ticker", F.lit(1).cast("long").alias("n"), F.col("score").cast("long").alias("sc"))
    if ticks is not None:
        none = F.lit(0).cast("long")
        rows = rows.unionByName(ticks.select(F.col("ts").cast("timestamp").alias("ts"), F.lit(NO_TICKER).alias("ticker"), none.alias("n"), none.alias("sc")))
    timed = rows.withWatermark("ts", watermark)
    panes = timed.groupBy(F.window("ts", slide).alias("w"), "ticker").agg(F.sum("n").alias("n"), F.sum("sc").alias("sc"))
    held = timed.groupBy(F.window("ts", slide).alias("w")).agg(F.count(F.lit(1)).alias("n")).select(F.window_time("w").alias("at"), "n")
    ended = held.groupBy(F.window("at", window, slide).alias("w")).agg(F.sum("n").alias("n"))
    last = pane_index(instant_wall_clock(F.col("w.end")), _seconds(slide)) - 1
    none = F.lit(None).cast("long")
    return panes.select("ticker", last.alias("pane"), "n", "sc").unionByName(
        ended.select(F.lit(None).cast("string").alias("ticker"), last.alias("pane"), none.alias("n"), none.alias("sc")))


def snapshots_of(runs: DataFrame, ended: DataFrame, window: str, slide: str, k: int = 5) -> DataFrame:
    """timestamp (the window's end), id (rank from 0), ticker, frequency,
    sentiment: the top k of each window of ``runs`` (STM-7). A window of
    ``ended`` (``timestamp``) without a ticker has one row, of rank 0, whose ticker is null."""
    top = top_of_runs(runs, window, slide, k).select(F.col("window_end_ms").alias("timestamp"), "id", "ticker", "frequency", "sentiment")
    none = F.lit(0).cast("long")
    blank = ended.select("timestamp", none.alias("id"), F.lit(None).cast("string").alias("ticker"), none.alias("frequency"), none.alias("sentiment"))
    # The blank row of a window that has a ticker goes; the top's rows have one at rank 0.
    both = top.unionByName(blank)
    found = F.max(F.col("ticker").isNotNull()).over(Window.partitionBy("timestamp"))
    return both.withColumn("_found", found).where("ticker IS NOT NULL OR NOT _found").drop("_found")


def _day(column: str):
    return F.floor(F.col(column) / BLOCK_MS)


def _within(runs: DataFrame, first: int, last: int) -> DataFrame:
    """The runs' windows that end from ``first`` to ``last``."""
    cut = runs.withColumns({"first_end_ms": F.greatest("first_end_ms", F.lit(first).cast("long")), "last_end_ms": F.least("last_end_ms", F.lit(last).cast("long"))})
    return cut.where(F.col("first_end_ms") <= F.col("last_end_ms"))


def _by_day(runs: DataFrame, step: int) -> DataFrame:
    """``COUNTS``: runs cut where a day begins."""
    cut = runs.withColumn("_d", F.explode(F.sequence(_day("first_end_ms"), _day("last_end_ms"))))
    begin = F.ceil(F.col("_d") * BLOCK_MS / F.lit(step)) * step
    end = F.ceil((F.col("_d") + 1) * BLOCK_MS / F.lit(step)) * step - step
    return cut.select("ticker", F.greatest("first_end_ms", begin).alias("first_end_ms"), F.least("last_end_ms", end).alias("last_end_ms"),
                      "frequency", "sentiment", F.lit(step).cast("long").alias("step_ms")).where("first_end_ms <= last_end_ms")


def run_top_trending(spark: SparkSession, posts: DataFrame, counts_path: str | None, snapshots_path: str,
                     checkpoint: str, window: str = "10 minutes", slide: str = "5 seconds", k: int = 5,
                     available_now: bool = True, processing_time: str = "5 seconds",
                     state_partitions: int | None = None, watermark: str = "10 seconds",
                     ticks: DataFrame | None = None, lexicon: Lexicon = DEFAULT_LEXICON):
    """Start the sliding top-k query: a snapshot of every window as it ends
    (SNK-6), and the counts of all tickers where ``counts_path`` is given.
    ``read_snapshots`` and ``read_counts`` read them. Panes that windows of
    later batches hold are kept beside the checkpoint. Returns the query."""
    step, k_panes = _seconds(slide) * 1000, _seconds(window) // _seconds(slide)
    held_path = f"{checkpoint.rstrip('/')}-panes"
    make_folder(spark, snapshots_path)
    if counts_path is not None:
        make_folder(spark, counts_path)

    def per_batch(df: DataFrame, batch_id: int) -> None:
        df.persist()  # what left the state in this batch
        try:
            held = spark.createDataFrame([], PANES)
            if batch_id > 0:
                held = spark.read.schema(PANES).parquet(f"{held_path}/{(batch_id - 1) % 2}")
            panes = held.unionByName(df.where(F.col("ticker") != NO_TICKER))
            ended = df.where(F.col("ticker").isNull()).select(((F.col("pane") + 1) * step).alias("timestamp"))
            first, last = ended.agg(F.min("timestamp"), F.max("timestamp")).first()
            if last is not None:
                n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
                runs = _within(runs_of_panes(panes, window, slide, n_parts), first, last)
                if counts_path is not None:
                    write_batch(_by_day(runs, step), counts_path, batch_id, _day("first_end_ms"))
                write_batch(snapshots_of(runs, ended, window, slide, k).withColumn("written_at", F.current_timestamp()), snapshots_path, batch_id, _day("timestamp"))
                panes = panes.where(F.col("pane") > last // step - k_panes)
            # A replay reads what the batch before has left, and writes its own anew.
            panes.write.mode("overwrite").parquet(f"{held_path}/{batch_id % 2}")
        finally:
            df.unpersist()

    w = (stream_panes(posts, window, slide, watermark, ticks, lexicon).writeStream.outputMode("append")
         .option("checkpointLocation", checkpoint).foreachBatch(per_batch))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return start_stream(w, spark, state_partitions)


def _read(spark: SparkSession, path: str, schema: str, days: tuple[int, int] | None) -> DataFrame:
    rows = spark.read.schema(f"{schema}, block long, batch_id long").parquet(path)
    if days is not None:
        rows = rows.where(F.col("block").between(*days))
    return rows.drop("block", "batch_id")


def read_snapshots(spark: SparkSession, path: str, days: tuple[int, int] | None = None) -> DataFrame:
    """All snapshots, or those of some days (since 1970), whose folders alone are opened."""
    return _read(spark, path, SNAPSHOTS, days)


def read_counts(spark: SparkSession, path: str, days: tuple[int, int] | None = None) -> DataFrame:
    """The counts of all finished windows, or of those that end on some days."""
    return unfold_runs(_read(spark, path, COUNTS, days))


def stream_pane_counts(posts: DataFrame, slide: str = "5 seconds", lexicon: Lexicon = DEFAULT_LEXICON) -> DataFrame:
    """``PANES`` as a running aggregate: each change of a pane at once (update
    mode), also of late posts, at the price of a state that keeps every pane."""
    occ = occurrences_at_time(posts, lexicon)
    return (occ.groupBy("ticker", pane_index(F.col("ts"), _seconds(slide)).alias("pane"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum("score").cast("long").alias("sc")))


class WindowTable(BlockTable):
    """Panes by the day of their end, read as the windows that hold them: a
    change of a pane is one row, not one for each of its windows."""

    def __init__(self, spark: SparkSession, path: str, window: str, slide: str, like: DataFrame):
        if _seconds(window) % _seconds(slide):
            raise ValueError("window must be a multiple of slide")
        self.window, self.slide = window, slide
        day = F.floor((F.col("pane") + 1) * (_seconds(slide) * 1000) / BLOCK_MS)
        super().__init__(spark, path, ["pane", "ticker"], self._label(day), like.schema)

    @staticmethod
    def _label(day):
        return F.lpad(day.cast("string"), 6, "0")

    def read(self, blocks: tuple[str, str] | None = None) -> DataFrame:
        """ticker, window_end_ms, frequency, sentiment; ``blocks`` (first, last)
        are the days in which windows end, of which the panes alone are read."""
        before = -(-_seconds(self.window) * 1000 // BLOCK_MS)
        panes = super().read(blocks and (f"{int(blocks[0]) - before:06d}", blocks[1]))
        n_parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        counts = unfold_runs(runs_of_panes(panes, self.window, self.slide, n_parts), self.slide)
        return counts if blocks is None else counts.where(self._label(_day("window_end_ms")).between(*blocks))


def run_sliding_counts(spark: SparkSession, posts: DataFrame, counts_path: str, checkpoint: str,
                       window: str = "10 minutes", slide: str = "5 seconds", available_now: bool = True,
                       processing_time: str = "5 seconds", state_partitions: int | None = None):
    """Start the running form into a table cut by day. Returns ``(query, WindowTable)``."""
    panes = stream_pane_counts(posts, slide)
    table = WindowTable(spark, counts_path, window, slide, panes)
    w = (panes.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
         .foreachBatch(table.merge))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return start_stream(w, spark, state_partitions), table
