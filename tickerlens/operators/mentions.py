"""Mention and sentiment series, trending and extremes (JOB-1, JOB-2, JOB-6, JOB-7).

Plan shape: one scan of the posts, row-local parse/score/explode inside one
codegen stage, then a single hash aggregate with map-side partial
aggregation. A hot ticker only costs one partial row per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickerlens.functions.lexicon import DEFAULT_LEXICON, Lexicon
from tickerlens.functions.text import author_importance as _importance
from tickerlens.functions.text import cashtags, post_score, strip_cashtag, tokens
from tickerlens.functions.timefn import (grain_columns, grain_parts, normalize_grain, parse_post_time,
                                         parts_to_timestamp)


def post_times(posts: DataFrame) -> DataFrame:
    """Posts with their parsed NTZ time ``ts`` next to the raw fields."""
    return posts.withColumn("ts", parse_post_time(F.col("created_at")))


def mention_occurrences(posts: DataFrame, grain: str, lexicon: Lexicon = DEFAULT_LEXICON,
                        keep_text: bool = False) -> DataFrame:
    """One row per cashtag occurrence: time parts, ticker, score of the post.
    Posts whose time does not parse are rejects and are left out."""
    # Rejects (unparseable time) drop out inside the generator: explode of a
    # null array emits no row. A Filter here would be pushed below the
    # projection that builds the time and evaluate it twice.
    timed = posts.select(parse_post_time(F.col("created_at")).alias("_ts"), "text")
    tags = F.when(F.col("_ts").isNotNull(), cashtags(F.col("text")))
    cols = grain_parts(F.col("_ts"), grain) + [post_score(F.col("text"), lexicon).alias("score"),
                                               F.explode(tags).alias("cashtag")]
    if keep_text:
        cols.insert(0, F.col("text"))
    out = timed.select(*cols)
    keep = (["text"] if keep_text else []) + list(grain_columns(grain))
    return out.select(*keep, strip_cashtag(F.col("cashtag")).alias("ticker"), "score")


def mention_series(posts: DataFrame, grain: str, lexicon: Lexicon = DEFAULT_LEXICON) -> DataFrame:
    """parts, ticker, frequency, sentiment (BIGINT) per (bucket, ticker)."""
    parts = list(grain_columns(grain))
    return (mention_occurrences(posts, grain, lexicon)
            .groupBy(*parts, "ticker")
            .agg(F.count(F.lit(1)).alias("frequency"), F.sum("score").cast("long").alias("sentiment")))


def fold_series(series: DataFrame, grain: str, to_grain: str) -> DataFrame:
    """A coarser series from a finer one, sums of its sums: posts are not read
    again. Weeks cross months, so they fold from days or finer."""
    have, want = grain_columns(grain), grain_columns(to_grain)
    if normalize_grain(to_grain) == "WEEK" and "day" in have:
        cols = grain_parts(parts_to_timestamp(grain), "WEEK")
    elif normalize_grain(grain) != "WEEK" and have[:len(want)] == want:
        cols = [F.col(c) for c in want]
    else:
        raise ValueError(f"{to_grain} does not fold from {grain}")
    return (series.select(*cols, "ticker", "frequency", "sentiment").groupBy(*want, "ticker")
            .agg(F.sum("frequency").alias("frequency"), F.sum("sentiment").alias("sentiment")))


#: Each grain and the one that it folds from; the finest is counted from posts.
FOLDS = (("HR", "MIN"), ("DAY", "HR"), ("WEEK", "DAY"), ("MONTH", "DAY"), ("YEAR", "MONTH"))


def mention_series_join_form(posts: DataFrame, grain: str, lexicon: Lexicon = DEFAULT_LEXICON) -> DataFrame:
    """The same series computed the reference's way, for parity (JOI-1, AGG-2, ARR-2).

    Sentiment is summed per (bucket, text) over exploded tokens, re-exploded by
    the text's cashtags and summed per (bucket, ticker); frequency is counted
    separately; both sides meet in an inner equi-join on (bucket, ticker).
    Both sides are hash-partitioned on the same keys, so the join adds no
    exchange of its own.
    """
    parts = list(grain_columns(grain))
    timed = posts.select(parse_post_time(F.col("created_at")).alias("_ts"), "text")
    base = timed.select(*grain_parts(F.col("_ts"), grain), "text", F.col("_ts").isNotNull().alias("_ok"))
    freq = (base.select(*parts, F.explode(F.when(F.col("_ok"), cashtags(F.col("text")))).alias("tag"))
            .groupBy(*parts, "tag").agg(F.count(F.lit(1)).alias("frequency")))
    words = base.select(*parts, "text", F.explode(F.when(F.col("_ok"), tokens(F.col("text")))).alias("w"))
    by_text = (words.groupBy(*parts, "text")
               .agg(F.sum(lexicon.polarity(F.col("w"))).alias("s")))
    senti = (by_text.select(*parts, "s", F.explode(cashtags(F.col("text"))).alias("tag"))
             .groupBy(*parts, "tag").agg(F.sum("s").cast("long").alias("sentiment")))
    return (freq.join(senti, on=parts + ["tag"], how="inner")
            .select(*parts, strip_cashtag(F.col("tag")).alias("ticker"), "frequency", "sentiment"))


def mention_series_with_lexicon(posts: DataFrame, grain: str, lexicon: DataFrame) -> DataFrame:
    """``mention_series`` with a lexicon table ``(word, polarity)`` of any size (LEX-1).

    Mentions count 1 and score 0; each token that the lexicon knows adds its
    polarity to every mention of its post and counts 0. Both kinds of rows go
    into one aggregate, so posts need no key and no text is shuffled."""
    parts = list(grain_columns(grain))
    timed = posts.select(parse_post_time(F.col("created_at")).alias("_ts"), "text")
    tags = F.when(F.col("_ts").isNotNull(), cashtags(F.col("text")))
    base = timed.select(*grain_parts(F.col("_ts"), grain), tags.alias("_tags"), "text")
    mentions = base.select(*parts, F.explode("_tags").alias("tag"), F.lit(1).alias("n"), F.lit(0).alias("score"))
    words = lexicon.groupBy("word").agg(F.max("polarity").alias("polarity"))
    known = (base.where(F.size("_tags") > 0).select(*parts, "_tags", F.explode(tokens(F.col("text"))).alias("word"))
             .join(words, "word"))
    scored = known.select(*parts, F.explode("_tags").alias("tag"), F.lit(0).alias("n"), F.col("polarity").alias("score"))
    return (mentions.unionByName(scored).groupBy(*parts, strip_cashtag(F.col("tag")).alias("ticker"))
            .agg(F.sum("n").alias("frequency"), F.sum("score").cast("long").alias("sentiment")))


def top_trending(series: DataFrame, grain: str, k: int | None = None,
                 distinct_frequency: bool = False) -> DataFrame:
    """Rank tickers within each bucket by frequency desc, ticker asc (WIN-1, SRT-1).

    ``k`` keeps the top k (Spark inserts a partial WindowGroupLimit before the
    shuffle); without it a bucket is ranked block by block. ``distinct_frequency`` keeps one ticker per (bucket, frequency),
    the smallest, as a store keyed without the ticker would (WIN-6).
    """
    parts = list(grain_columns(grain))
    s = series
    if distinct_frequency:
        wf = Window.partitionBy(*parts, "frequency").orderBy(F.asc("ticker"))
        s = s.withColumn("_r", F.row_number().over(wf)).where(F.col("_r") == 1).drop("_r")
    if k is None:
        return _ranked_in_blocks(s, parts)
    w = Window.partitionBy(*parts).orderBy(F.desc("frequency"), F.asc("ticker"))
    return s.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= k)


def _ranked_in_blocks(series: DataFrame, parts: list[str]) -> DataFrame:
    """Every ticker's rank in its bucket, without sorting a bucket in one task.

    Tickers of one frequency and one two-letter beginning are a block. Blocks
    are counted with partial sums, their first ranks are running sums over the
    few blocks of a bucket, and only within a block are tickers sorted. Blocks
    join on one struct, which is never null: for columns that could be, the
    join would add filters, pushed down to where each of them parses a post's
    time once more."""
    block = [*parts, "frequency", "_start"]
    rows = series.withColumn("_start", F.substring("ticker", 1, 2)).withColumn("_block", F.struct(*block))
    sizes = rows.groupBy(*block).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*parts).orderBy(F.desc("frequency"), "_start").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select(F.struct(*block).alias("_block"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    inside = Window.partitionBy("_block").orderBy("ticker")
    placed = rows.withColumn("_place", F.row_number().over(inside)).join(first, "_block")
    return placed.select(*series.columns, (F.col("_first") + F.col("_place")).cast("long").alias("rank"))


def trending(posts: DataFrame, grain: str, k: int | None = None, distinct_frequency: bool = False,
             lexicon: Lexicon = DEFAULT_LEXICON) -> DataFrame:
    """JOB-2 end to end: posts -> series -> ranked per bucket."""
    return top_trending(mention_series(posts, grain, lexicon), grain, k, distinct_frequency)


def trending_lists(ranked: DataFrame, grain: str, k: int = 5) -> DataFrame:
    """Per bucket, the top-k tickers as one ordered list (AGG-12, list form).

    Only rows with rank <= k reach the collect, so no list exceeds k."""
    parts = list(grain_columns(grain))
    top = ranked.where(F.col("rank") <= k)
    return (top.groupBy(*parts)
            .agg(F.array_sort(F.collect_list(F.struct("rank", "ticker"))).alias("_l"))
            .select(*parts, F.transform("_l", lambda x: x["ticker"]).alias("tickers")))


def sorted_series(series: DataFrame, grain: str) -> DataFrame:
    """Global order bucket desc, frequency desc, ticker asc on typed parts
    (SRT-1; numeric, so months sort correctly, quirk Q6). A range-partitioned
    sort: use only where a total order is the output."""
    parts = list(grain_columns(grain))
    return series.orderBy(*[F.desc(c) for c in parts], F.desc("frequency"), F.asc("ticker"))


def sentiment_extremes(posts: DataFrame, grain: str, k: int = 5, positive: bool = True,
                       lexicon: Lexicon = DEFAULT_LEXICON) -> DataFrame:
    """The k most positive (or negative) post-ticker occurrences per bucket
    (WIN-2, WIN-3): scores are per post, not summed per ticker; repeats allowed.
    Ties break by ticker, then text."""
    parts = list(grain_columns(grain))
    occ = mention_occurrences(posts, grain, lexicon, keep_text=True)
    first = F.desc("score") if positive else F.asc("score")
    w = Window.partitionBy(*parts).orderBy(first, F.asc("ticker"), F.asc("text"))
    return (occ.withColumn("rank", F.row_number().over(w).cast("long"))
            .where(F.col("rank") <= k)
            .select(*parts, "ticker", F.col("score").cast("long").alias("sentiment"), "rank"))


def global_top(posts: DataFrame, by: str = "frequency", n: int = 10, ascending: bool = False,
               lexicon: Lexicon = DEFAULT_LEXICON) -> DataFrame:
    """Top n tickers over the whole feed by mention count or summed sentiment
    (SRT-7, SRT-8). ``orderBy().limit()`` plans as TakeOrderedAndProject."""
    if by not in ("frequency", "sentiment"):
        raise ValueError("by must be 'frequency' or 'sentiment'")
    occ = mention_occurrences(posts, "YEAR", lexicon).select("ticker", "score")
    agg = occ.groupBy("ticker").agg(F.count(F.lit(1)).alias("frequency"),
                                    F.sum("score").cast("long").alias("sentiment"))
    order = F.asc(by) if ascending else F.desc(by)
    return (agg.orderBy(order, F.asc("ticker")).limit(n)
            .select("ticker", F.col(by).alias("value")))


def author_importance(posts: DataFrame) -> DataFrame:
    """id, followers, friends, importance (PRJ-2, MTH-1, PRJ-5)."""
    fo = F.col("user.followers_count")
    fr = F.col("user.friends_count")
    return posts.select("id", fo.alias("followers"), fr.alias("friends"),
                        _importance(fo, fr).alias("importance"))
