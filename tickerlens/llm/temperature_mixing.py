"""Mixing sources by temperature (DataFrame functions only).

A source with share p of all tokens gets weight p^a / sum p^a.  The exponent a
is bisected between 1 (as the corpus is) and 0 (all sources alike): the
largest a whose weights reach the target entropy, but never so small that a
source would be repeated more than the limit.  A pass over the table of
sources evaluates 31 exponents, which is five halvings at once.

The weights are then realised in tokens.  A source that needs its documents
2.3 times gives two full copies and part of a third: its documents are dealt
into blocks by a hash (the permutation), blocks are taken in order until the
budget falls into one, and in that block documents are taken in hash order up
to the budget.  So the only ordering work is within blocks, and a selection is
a rule that a row can evaluate by itself: copies, last block, last hash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickerlens.llm.common import SALTS, cut
from tickerlens.llm.quality_rules import word_array

TARGET_ENTROPY = 0.95  # of the logarithm of the number of sources
MAX_REPEATS = 4.0
BLOCK_DOCS = 1024
HALVINGS = 5
PASSES = 6
SEED = 20_260_101


def n_tokens(text: Column) -> Column:
    """Words of a text; at least one, so that empty documents have a place."""
    return F.greatest(F.size(word_array(text)), F.lit(1)).cast("long")


def bisect_exponent(totals: DataFrame, target_entropy: float = TARGET_ENTROPY, max_repeats: float = MAX_REPEATS, budget: float | None = None) -> tuple[float, dict[str, float]]:
    """The exponent for ``totals`` (source, tokens), and the sums that turn
    shares into weights.  Without a ``budget`` in tokens, it is the least that
    takes every document once."""
    size = totals.agg(F.sum("tokens").alias("all"), F.count("*").alias("n"), F.max("tokens").alias("most")).first()
    if not size["n"]:
        return 1.0, {"all": 0, "z": 1.0, "budget": 0.0}
    everything, goal = float(size["all"]), target_entropy * math.log(size["n"]) if size["n"] > 1 else 0.0

    def measured(exponents: list[float]) -> dict[float, tuple[bool, bool, float]]:
        p, a = F.col("tokens") / everything, F.col("a")
        rows = totals.select(p.alias("p"), F.explode(F.array(*map(F.lit, exponents))).alias("a"))
        rows = rows.groupBy("a").agg(F.sum(F.pow("p", a)).alias("z"), F.sum(F.pow("p", a) * F.log("p")).alias("y"), F.max(F.pow("p", a - 1)).alias("r")).collect()
        found = {}
        for row in rows:
            entropy = math.log(row["z"]) - row["a"] * row["y"] / row["z"]
            spent = (budget or everything / (size["most"] / everything) ** (row["a"] - 1) * row["z"]) / everything
            found[row["a"]] = entropy >= goal - 1e-12, row["r"] / row["z"] * spent <= max_repeats * (1 + 1e-12), row["z"]
        return found

    def bisected(wanted: int, from_top: bool) -> float:
        """The largest exponent (from_top) or the least for which a condition holds."""
        low, high, ends = 0.0, 1.0, measured([0.0, 1.0])
        if from_top and (ends[1.0][wanted] or not ends[0.0][wanted]):
            return 1.0 if ends[1.0][wanted] else 0.0
        if not from_top and (ends[0.0][wanted] or not ends[1.0][wanted]):
            return 0.0 if ends[0.0][wanted] else 1.0
        for _ in range(PASSES):
            steps = [low + (high - low) * i / 2**HALVINGS for i in range(1, 2**HALVINGS)]
            ok = {a: x[wanted] for a, x in measured(steps).items()}
            grid = [low, *steps, high]
            turns = next(i for i in range(1, len(grid)) if grid[i] == high or ok[grid[i]] != from_top)
            low, high = grid[turns - 1], grid[turns]
        return low if from_top else high

    a = max(bisected(0, True), bisected(1, False))
    z = measured([a])[a][2]
    spent = budget or everything * z / (size["most"] / everything) ** (a - 1)
    return a, {"all": everything, "z": z, "budget": spent}


def _order(full: Column, kind: str) -> Column:
    return F.xxhash64(F.col("_id"), F.col("_tokens"), full, F.lit(kind), F.lit(SEED))


def _by_source(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows with their source's line of the plan.  The plan is repeated for a
    few salts, so that a source's rows spread over as many tasks."""
    plan = plan.withColumnRenamed("source", "_plan_source").withColumn("_salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
    rows = rows.withColumn("_row_salt", F.pmod(F.xxhash64("_id", "_tokens"), F.lit(SALTS)).cast("int"))
    on = rows["_source"].eqNullSafe(plan["_plan_source"]) & (rows["_row_salt"] == plan["_salt"])
    return rows.join(plan, on).drop("_plan_source", "_salt", "_row_salt")


def mixing_plan(rows: DataFrame, target_entropy: float = TARGET_ENTROPY, max_repeats: float = MAX_REPEATS, budget: float | None = None) -> DataFrame:
    """For each source of ``rows`` (_id, _source, _tokens): tokens, weight,
    repeats, and the rule: ``full`` copies, blocks, ``edge`` block, ``last`` hash."""
    totals = cut(rows.groupBy(F.col("_source").alias("source")).agg(F.sum("_tokens").alias("tokens"), F.count("*").alias("docs")))
    a, sums = bisect_exponent(totals, target_entropy, max_repeats, budget)
    weight = F.pow(F.col("tokens") / sums["all"], F.lit(a)) / sums["z"]
    plan = totals.withColumn("weight", weight).withColumn("repeats", F.col("weight") * sums["budget"] / F.col("tokens"))
    whole = F.floor(F.col("repeats") + 1e-9)
    plan = plan.select(
        "*",
        whole.cast("int").alias("full"),
        F.greatest(F.lit(0.0), F.round((F.col("repeats") - whole) * F.col("tokens"), 3)).alias("rest"),
        F.ceil(F.col("docs") / F.greatest(F.lit(float(BLOCK_DOCS)), F.sqrt("docs"))).alias("blocks"),
    )
    part = _by_source(rows, plan.where("rest > 0")).withColumn("_block", F.pmod(_order(F.col("full"), "block"), F.col("blocks")))
    sizes = part.groupBy(F.col("_source").alias("source"), "_block").agg(F.sum("_tokens").alias("n"), F.first("rest").alias("rest"))
    before = W.partitionBy("source").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    # The block into which the budget falls, and what it has left there.
    edge = sizes.where((F.col("before") < F.col("rest")) & (F.col("rest") <= F.col("before") + F.col("n") + 1e-3))
    edge = edge.groupBy("source").agg(F.min("_block").alias("edge"), F.min(F.struct("_block", (F.col("rest") - F.col("before")).alias("left"))).alias("at"))
    plan = plan.withColumnRenamed("source", "_s")
    plan = plan.join(edge, plan["_s"].eqNullSafe(edge["source"]), "left").select(F.col("_s").alias("source"), "tokens", "weight", "repeats", "full", "blocks", "edge", F.col("at.left").alias("left"))
    inside = _by_source(rows, plan.where("edge is not null").select("source", "full", "blocks", "edge", "left"))
    inside = inside.where(F.pmod(_order(F.col("full"), "block"), F.col("blocks")) == F.col("edge")).withColumn("_place", _order(F.col("full"), "place"))
    so_far = W.partitionBy("_source").orderBy("_place").rangeBetween(W.unboundedPreceding, W.currentRow)
    last = inside.withColumn("upto", F.sum("_tokens").over(so_far)).where(F.col("upto") >= F.col("left") - 1e-3).groupBy("_source").agg(F.min("_place").alias("last"))
    return cut(plan.join(last, plan["source"].eqNullSafe(last["_source"]), "left").drop("_source"))


def _copies(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` once for each copy, with ``copy`` and ``block``."""
    rows = _by_source(rows, plan.select("source", "full", "blocks", "edge", "last"))
    block, place = F.pmod(_order(F.col("full"), "block"), F.col("blocks")), _order(F.col("full"), "place")
    partly = (block < F.col("edge")) | ((block == F.col("edge")) & (F.col("last").isNull() | (place <= F.col("last"))))
    n = F.col("full") + F.when(partly, 1).otherwise(0)
    rows = rows.where(n > 0).withColumn("copy", F.explode(F.sequence(F.lit(0), n - 1)))
    return rows.withColumn("block", F.pmod(_order(F.col("copy"), "block"), F.col("blocks"))).drop("full", "blocks", "edge", "last")


def _rows(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("_id"), F.col(source_col).cast("string").alias("_source"), n_tokens(F.col(text_col).cast("string")).alias("_tokens"))


def mixed_order(docs: DataFrame, target_entropy: float = TARGET_ENTROPY, max_repeats: float = MAX_REPEATS, budget: float | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``(doc_id, source, tokens, copy, block, place)``: a row for each copy
    that the mixture takes of each row, with its place in the permutation of
    its source's copy.

    A null source is a source; null and empty texts count as one token.  Rows
    that repeat, share an id or have a null one are documents each for itself;
    those equal in id and length have equal hashes and go together.  Other
    columns are not read.  One source keeps weight 1.  No rows give no rows.
    """
    rows = cut(_rows(docs, id_col, text_col, source_col))
    taken = _copies(rows, mixing_plan(rows, target_entropy, max_repeats, budget))
    inside = W.partitionBy("_source", "copy", "block").orderBy(_order(F.col("copy"), "place"), "_id", "_tokens")
    return taken.select(F.col("_id").alias("doc_id"), F.col("_source").alias("source"), F.col("_tokens").alias("tokens"), "copy", "block", (F.row_number().over(inside) - 1).cast("long").alias("place"))


def mixed(docs: DataFrame, target_entropy: float = TARGET_ENTROPY, max_repeats: float = MAX_REPEATS, budget: float | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``docs``, with all their columns, as often as the mixture takes them."""
    plan = mixing_plan(cut(_rows(docs, id_col, text_col, source_col)), target_entropy, max_repeats, budget)
    rows = docs.select(F.struct("*").alias("_doc"), F.col(id_col).cast("long").alias("_id"), F.col(source_col).cast("string").alias("_source"), n_tokens(F.col(text_col).cast("string")).alias("_tokens"))
    return _copies(rows, plan).select("_doc.*")
