"""Quality rules with robust multivariate outliers (DataFrame functions only).

Plain rules come first: too few words, or too many inside repeated windows.
The rest are judged against their own kind: for each language and source, a
minimum-covariance-determinant estimate of the centre and the scatter of four
transformed statistics, fitted to the most central ``CORE`` of its documents
so that junk can't move it, and a document is rejected whose squared
Mahalanobis distance is above ``CUTOFF``.

The estimate starts from medians and median deviations and takes
concentration steps: the documents with the smallest distances under the last
estimate give the next one, which never has a larger determinant.  Which those
are is read from counts of distances in fine logarithmic bins, so a step costs
two aggregations over a narrow table with partial sums, and a source with a
third of all rows is no different from any other.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickerlens.llm.common import BLANK_RUN, cut

MIN_WORDS = 10
MAX_REPEATED = 20  # percent of words
REPEAT_WINDOW = 5
SYMBOLS = "#*$%&|<>"
CORE = 0.75
STEPS = 4
BINS_A_FACTOR_E = 64
#: Least standard deviation of each transformed statistic: clean kinds of
#: text have none at all of some, which would make any trace of it an outlier.
FLOORS = (0.15, 0.75, 0.75, 0.75)
#: Six standard deviations along any direction.
CUTOFF = 36.0
STATS = ("x0", "x1", "x2", "x3")


def chi2_cdf_even(x: float, df: int) -> float:
    """The chi-squared distribution function for an even number of degrees."""
    term, total = 1.0, 1.0
    for i in range(1, df // 2):
        term *= x / 2 / i
        total += term
    return 1 - math.exp(-x / 2) * total


def consistency(core: float = CORE, dims: int = len(STATS)) -> float:
    """What the scatter of the central ``core`` of normal data is short of."""
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf_even(mid, dims) < core else (low, mid)
    return core / chi2_cdf_even(low, dims + 2)


def word_array(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANK_RUN), "")


def text_statistics(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    n = REPEAT_WINDOW
    given = docs.columns
    text = F.coalesce(text.cast("string"), F.lit(""))
    rows = docs.withColumn("_text", text).withColumn("_words", word_array(F.col("_text")))
    rows = rows.withColumn("_lines", F.filter(F.split("_text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")))
    size = F.size("_words")
    starts = F.when(size >= n, F.sequence(F.lit(1), size - (n - 1)))
    hashes = F.transform(starts, lambda i: F.xxhash64(*(F.get(F.col("_words"), i + (k - 1)) for k in range(n))))
    rows = rows.withColumn("_hashes", hashes)
    # Only a text with two equal hashes can hold a window twice; there the words themselves decide.
    repeated = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    windows = F.transform(starts, lambda i: F.struct(F.array_join(F.slice("_words", i, n), " ").alias("w"), i.alias("at")))
    rows = rows.withColumn("_sorted", F.when(repeated, F.array_sort(windows)))
    same = lambda i, x: F.coalesce(F.get(F.col("_sorted"), i)["w"] == x["w"], F.lit(False))
    rows = rows.withColumn("_found", F.array_sort(F.transform(F.filter("_sorted", lambda x, i: same(i - 1, x) | same(i + 1, x)), lambda x: x["at"])))
    covered = F.aggregate(
        "_found",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-n).alias("last")),
        lambda a, at: F.struct((a["n"] + F.least(F.lit(n), at - a["last"])).alias("n"), at.alias("last")),
        lambda a: a["n"],
    )
    return rows.select(
        *given,
        size.cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))


def transformed() -> list[Column]:
    """Logarithms of the mean length of a word and of rates in a hundred words."""
    words = F.greatest("n_words", F.lit(1))
    rate = lambda c: F.log1p(100.0 * F.col(c) / words)
    made = [F.log(F.greatest(F.col("word_chars") / words, F.lit(0.01))), rate("n_symbols"), rate("n_dup_lines"), rate("n_repeat_words")]
    return [c.alias(x) for x, c in zip(STATS, made, strict=True)]


def cholesky(cov) -> dict[tuple[int, int], Column]:
    """Lower factor of a matrix of columns, ``cov(i, j)`` for i >= j."""
    low: dict[tuple[int, int], Column] = {}
    for i in range(len(STATS)):
        for j in range(i + 1):
            rest = cov(i, j)
            for k in range(j):
                rest = rest - low[i, k] * low[j, k]
            low[i, j] = F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j else rest / low[j, j]
    return low


def _factored(scatter: DataFrame, keys: list[str], scale: float) -> DataFrame:
    """Groups with centre m0.. and the factor l00.. of their floored scatter, named step by step."""
    names = [(i, j) for i in range(len(STATS)) for j in range(i + 1)]
    rows = scatter.select(*keys, *(f"m{i}" for i in range(len(STATS))), *(F.coalesce(F.col(f"c{i}{j}"), F.lit(0.0)).alias(f"c{i}{j}") for i, j in names))
    cov = lambda i, j: F.col(f"c{i}{j}") * scale + (F.lit(FLOORS[i] ** 2) if i == j else 0.0)
    low = cholesky(cov)
    return cut(rows.select(*keys, *(f"m{i}" for i in range(len(STATS))), *(low[i, j].alias(f"l{i}{j}") for i, j in names)))


def squared_distance() -> Column:
    """Mahalanobis, from columns x0.., m0.., l00..: forward substitution."""
    z: list[Column] = []
    for i, x in enumerate(STATS):
        rest = F.col(x) - F.col(f"m{i}")
        for j in range(i):
            rest = rest - F.col(f"l{i}{j}") * z[j]
        z.append(rest / F.col(f"l{i}{i}"))
    return sum((v * v for v in z[1:]), z[0] * z[0])


def _with_distance(stats: DataFrame, fit: DataFrame, keys: list[str]) -> DataFrame:
    other = fit.withColumnsRenamed({k: f"_{k}" for k in keys})
    on = None
    for k in keys:
        here = stats[k].eqNullSafe(other[f"_{k}"])
        on = here if on is None else on & here
    return stats.join(other, on, "left").select(*stats.columns, squared_distance().alias("d2"))


def fit_scatter(stats: DataFrame, keys: list[str], core: float = CORE, steps: int = STEPS) -> DataFrame:
    """The estimate for each group of ``stats`` (columns ``keys`` and x0..)."""
    medians = stats.groupBy(*keys).agg(*(F.percentile_approx(x, 0.5).alias(f"m{i}") for i, x in enumerate(STATS)))
    zero = {f"c{i}{j}": F.lit(0.0) for i in range(len(STATS)) for j in range(i + 1)}
    centred = _with_centre(stats, medians, keys)
    spread = centred.groupBy(*keys).agg(*(F.max(f"m{i}").alias(f"m{i}") for i in range(len(STATS))), *(F.percentile_approx(F.abs(F.col(x) - F.col(f"m{i}")), 0.5).alias(f"mad{i}") for i, x in enumerate(STATS)))
    spread = spread.withColumns(zero | {f"c{i}{i}": (1.4826 * F.col(f"mad{i}")) ** 2 for i in range(len(STATS))})
    fit = _factored(spread, keys, 1.0)
    for _ in range(steps):
        far = _with_distance(stats, fit, keys).withColumn("bin", F.floor(F.log(F.col("d2") + 1e-6) * BINS_A_FACTOR_E))
        bins = far.groupBy(*keys, "bin").agg(F.count("*").alias("n"))
        group = W.partitionBy(*keys)
        seen = bins.withColumn("upto", F.sum("n").over(group.orderBy("bin"))).withColumn("all", F.sum("n").over(group))
        edge = seen.where(F.col("upto") >= core * F.col("all")).groupBy(*keys).agg(F.min("bin").alias("edge"))
        edge = edge.withColumnsRenamed({k: f"_{k}" for k in keys})
        on = [far[k].eqNullSafe(edge[f"_{k}"]) for k in keys]
        inner = far.join(edge, on).where(F.col("bin") <= F.col("edge"))
        moments = [F.avg(x).alias(f"m{i}") for i, x in enumerate(STATS)]
        moments += [F.covar_pop(STATS[i], STATS[j]).alias(f"c{i}{j}") for i in range(len(STATS)) for j in range(i + 1)]
        fit = _factored(inner.groupBy(*keys).agg(*moments), keys, consistency(core))
    return fit


def _with_centre(stats: DataFrame, centres: DataFrame, keys: list[str]) -> DataFrame:
    other = centres.withColumnsRenamed({k: f"_{k}" for k in keys})
    return stats.join(other, [stats[k].eqNullSafe(other[f"_{k}"]) for k in keys]).drop(*(f"_{k}" for k in keys))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``(doc_id, row_hash, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, distance2, kept)``, a row for each row.

    A null or empty text has no words and fails the base rules.  Null
    languages and sources form groups of their own, as any value does.  Rows
    that repeat, share an id or have a null one are judged each for itself
    and count each in the estimates; ties in distance fall into one bin and
    are taken together.  A group whose documents all fail has no estimate and
    needs none.  ``row_hash`` (of id and text) tells rows with one id apart.
    Texts are taken whole.  Other columns are not read.  No rows give no rows.
    """
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"), F.col(text_col).cast("string").alias("_given"))
    rows = text_statistics(given.withColumn("row_hash", F.xxhash64("doc_id", "_given")), F.col("_given")).drop("_given")
    rows = cut(rows.withColumn("base_failed", base_failed()).select("*", *transformed()))
    keys = ["lang", "source"]
    fit = fit_scatter(rows.where(~F.col("base_failed")).select(*keys, *STATS), keys)
    far = _with_distance(rows, fit, keys)
    kept = ~F.col("base_failed") & (F.coalesce("d2", F.lit(0.0)) <= CUTOFF)
    return far.select("doc_id", "row_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", F.col("d2").alias("distance2"), kept.alias("kept"))


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **columns: str) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with all their columns."""
    bad = judge(docs, id_col, text_col, **columns).where("not kept").select("doc_id", "row_hash").distinct()
    doc = docs[id_col].cast("long")
    row = F.xxhash64(doc, docs[text_col].cast("string"))
    return docs.join(bad, (row == bad["row_hash"]) & doc.eqNullSafe(bad["doc_id"]), "left_anti")
