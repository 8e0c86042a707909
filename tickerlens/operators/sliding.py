"""Sliding-window counts and per-window top-k (STM-4, STM-7, WIN-4 in batch form).

Every event falls into window/slide windows. Counts change only where an
occurrence enters or leaves, so they are computed as *runs*: consecutive
windows of a ticker with the same counts, by running sums over what enters and
leaves. Only the output unfolds a run into its windows. Two exact plans:

* ``plain``: each post-ticker occurrence enters and leaves by itself.
* ``pane``: occurrences are first summed into slide-sized panes (tumbling,
  partial aggregate), and the pane sums enter and leave.

Both emit every window that overlaps an event, like Spark's ``window``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickerlens.functions.lexicon import DEFAULT_LEXICON, Lexicon
from tickerlens.functions.text import cashtags, post_score, strip_cashtag
from tickerlens.functions.timefn import _epoch_ntz, parse_post_time


def _seconds(spec: str) -> int:
    n, unit = spec.split()
    unit = unit.lower().rstrip("s")
    return int(n) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit]


def occurrences_at_time(posts: DataFrame, lexicon: Lexicon = DEFAULT_LEXICON) -> DataFrame:
    """One row per cashtag occurrence: ts (NTZ), ticker, score."""
    timed = posts.select(parse_post_time(F.col("created_at")).alias("ts"), "text")
    tags = F.when(F.col("ts").isNotNull(), cashtags(F.col("text")))  # rejects emit no row
    return (timed.select("ts", post_score(F.col("text"), lexicon).alias("score"), F.explode(tags).alias("tag"))
            .select("ts", strip_cashtag(F.col("tag")).alias("ticker"), "score"))


RUNS = "ticker string, first_end_ms long, last_end_ms long, frequency long, sentiment long"


def pane_index(ts, slide_seconds: int):
    """The pane of an NTZ time; it covers [pane*s, (pane+1)*s) seconds."""
    return F.floor(F.timestamp_diff("SECOND", _epoch_ntz(), ts) / slide_seconds)


def runs_of_panes(panes: DataFrame, window: str, slide: str, n_parts: int, block_panes: int | None = None) -> DataFrame:
    """Runs (``RUNS``) of rows ``ticker, pane, n, sc``, several for a pane or one.

    Window ends are cut into blocks; a row goes to the one or two blocks in
    which its windows end, so a hot ticker is split by block, and a run ends
    with its block. A run is no longer than a window has panes, since what is
    in it leaves by then."""
    k, step = _seconds(window) // _seconds(slide), _seconds(slide) * 1000
    span = block_panes or 24 * k
    blocks = F.sequence(F.floor((F.col("pane") + 1) / span), F.floor((F.col("pane") + k) / span))
    # The number of partitions is fixed: AQE would size it by the rows before they are unfolded.
    spread = panes.withColumn("block", F.explode(blocks)).repartition(n_parts, "ticker", "block")
    past = (F.col("block") + 1) * span
    enters = F.struct(F.greatest(F.col("pane") + 1, F.col("block") * span).alias("end"), F.col("n").alias("n"), F.col("sc").alias("sc"))
    leaves = F.struct(F.least(F.col("pane") + k + 1, past).alias("end"), (-F.col("n")).alias("n"), (-F.col("sc")).alias("sc"))
    changes = spread.select("ticker", "block", F.explode(F.array(enters, leaves)).alias("c")).select("ticker", "block", "c.*")
    w = Window.partitionBy("ticker", "block").orderBy("end")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = changes.select("ticker", "end", F.coalesce(F.lead("end").over(w), past).alias("next"),
                          F.sum("n").over(upto).alias("frequency"), F.sum("sc").over(upto).alias("sentiment"))
    # Of several changes at one end, the last one's sums hold all of them; the others' runs are empty.
    return (runs.where((F.col("next") > F.col("end")) & (F.col("frequency") > 0))
            .select("ticker", (F.col("end") * step).alias("first_end_ms"), ((F.col("next") - 1) * step).alias("last_end_ms"), "frequency", "sentiment"))


def sliding_runs(posts: DataFrame, window: str = "10 minutes", slide: str = "5 seconds",
                 form: str = "pane", lexicon: Lexicon = DEFAULT_LEXICON,
                 block_panes: int | None = None) -> DataFrame:
    """The counts of all windows as runs (``RUNS``; epoch ms, UTC wall clock)."""
    if _seconds(window) % _seconds(slide):
        raise ValueError("window must be a multiple of slide")
    occ = occurrences_at_time(posts, lexicon)
    rows = occ.select("ticker", pane_index(F.col("ts"), _seconds(slide)).alias("pane"), F.lit(1).cast("long").alias("n"), F.col("score").cast("long").alias("sc"))
    if form == "pane":
        rows = rows.groupBy("ticker", "pane").agg(F.sum("n").alias("n"), F.sum("sc").alias("sc"))
    elif form != "plain":
        raise ValueError("form must be 'pane' or 'plain'")
    n_parts = int(posts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return runs_of_panes(rows, window, slide, n_parts, block_panes)


def unfold_runs(runs: DataFrame, slide: str | None = None) -> DataFrame:
    """ticker, window_end_ms, frequency, sentiment of each window of the runs;
    without ``slide``, their column ``step_ms`` says how far ends are apart."""
    step = F.col("step_ms") if slide is None else F.lit(_seconds(slide) * 1000).cast("long")
    return runs.select("ticker", F.explode(F.sequence("first_end_ms", "last_end_ms", step)).alias("window_end_ms"), "frequency", "sentiment")


def sliding_counts(posts: DataFrame, window: str = "10 minutes", slide: str = "5 seconds",
                   form: str = "pane", lexicon: Lexicon = DEFAULT_LEXICON,
                   block_panes: int | None = None) -> DataFrame:
    """ticker, window_end_ms (epoch ms, UTC wall clock), frequency, sentiment."""
    return unfold_runs(sliding_runs(posts, window, slide, form, lexicon, block_panes), slide)


def top_of_runs(runs: DataFrame, window: str = "10 minutes", slide: str = "5 seconds", k: int = 5) -> DataFrame:
    """``top_per_window`` of the windows of ``runs``, without unfolding them all.

    Each run is cut into aligned pieces of 1, 2, 4, ... windows, two of a
    length at most. All runs of a piece are there in each of its windows, so
    only the first k of a piece can be among the first k of a window: those are
    unfolded and ranked."""
    step = _seconds(slide) * 1000
    lo, hi = F.floor(F.col("first_end_ms") / step), F.floor(F.col("last_end_ms") / step) + 1
    pieces = []
    for level in range((_seconds(window) // _seconds(slide)).bit_length()):
        size = 1 << level
        left, right = F.floor((F.col("_lo") + size - 1) / size), F.floor(F.col("_hi") / size)
        for odd, at in ((left, left), (right, right - 1)):
            there = (left < right) & (F.pmod(odd, F.lit(2)) == 1)
            pieces.append(F.when(there, F.struct(F.lit(size).cast("long").alias("size"), at.alias("at"))))
    cut = (runs.select("ticker", "frequency", "sentiment", lo.alias("_lo"), hi.alias("_hi"))
           .select("ticker", "frequency", "sentiment", F.explode(F.array(*pieces)).alias("_p")).where(F.col("_p").isNotNull())
           .select("ticker", "frequency", "sentiment", "_p.size", "_p.at"))
    w = Window.partitionBy("size", "at").orderBy(F.desc("frequency"), F.asc("ticker"))
    first = cut.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k)
    ends = F.sequence(F.col("at") * F.col("size"), (F.col("at") + 1) * F.col("size") - 1)
    rows = first.select("ticker", F.explode(ends).alias("_end"), "frequency", "sentiment")
    return top_per_window(rows.select("ticker", (F.col("_end") * step).alias("window_end_ms"), "frequency", "sentiment"), k)


def top_per_window(counts: DataFrame, k: int = 5) -> DataFrame:
    """Rank 0..k-1 per window by frequency desc, ticker asc (STM-7, WIN-4)."""
    w = Window.partitionBy("window_end_ms").orderBy(F.desc("frequency"), F.asc("ticker"))
    # Filter on the raw row_number so Catalyst plans a WindowGroupLimit.
    ranked = counts.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k)
    return ranked.withColumn("id", (F.col("_rn") - 1).cast("long")).drop("_rn")
