"""Near-duplicate embeddings by an exact metric range join.

On unit vectors, cosine at least c is distance at most r = sqrt(2 - 2c).
Pivots split each label's vectors into cells: a vector is at home with its
nearest pivot.  By the triangle inequality (in Euclidean space, in its
sharper form) a vector at distance at most r from a member of cell j lies no
further than r beyond the boundary of j, so it is sent there too exactly if
(d_j^2 - d_i^2) / (2 |p_i - p_j|) <= r.  Each cell then finds all links of the
vectors at home in it, by itself.  Cells with more than ``BLOCK`` vectors are
dealt out as pairs of blocks.

Equal vectors are one class from the start.  A task returns a number of links
for each of its vectors and a forest of the links it found, never the pairs.

Pivots are some of the vectors, at most about ``MAX_PIVOTS``; how many, and
which, is the choice that makes the least work on a sample.  They decide where
work is done, not what is found.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerlens.llm.common import Rows, components, cut, grouped, spread_join

CELL = 4096
BLOCK = 4096
MAX_PIVOTS = 4096
SLICE = 512  # rows whose distances to all pivots are held at a time
SENT = 8192  # rows sent to cells at a time
ROW_COST = 500  # a row sent to a cell, in pairs compared there
SLACK = 1e-9
UNIT = "label long, dims int, cell long, rep long, copies long, home boolean, vec binary"


def unit_vector(values: list | None) -> np.ndarray | None:
    """In double precision; None for what links with nothing."""
    if not values or any(v is None for v in values):
        return None
    v = np.asarray(values, np.float64)
    if not np.isfinite(v).all() or not v.any():
        return None
    v = v / np.abs(v).max()
    return v / math.sqrt(float(v @ v)) + 0.0  # + 0.0: no negative zeros, which would tell equal vectors apart


def _prepared(rows: DataFrame) -> DataFrame:
    """``(vec_id, label, dims, digest, vec)`` by key: unit vectors as bytes,
    null for those that link with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, digests, vecs = [], [], []
            for values, label in zip(batch.column(2).to_pylist(), batch.column(1).to_pylist(), strict=True):
                v = None if label is None else unit_vector(values)
                raw = None if v is None else v.tobytes()
                dims.append(None if v is None else len(v))
                given = None if v is None else np.asarray(values, np.float64) + 0.0
                digests.append(None if v is None else hashlib.blake2b(given.tobytes(), digest_size=16).digest())
                vecs.append(raw)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(dims, pa.int32()), pa.array(digests, pa.binary()), pa.array(vecs, pa.binary())], ["vec_id", "label", "dims", "digest", "vec"])

    return rows.select(F.col("key").alias("vec_id"), "label", "values").mapInArrow(run, "vec_id long, label long, dims int, digest binary, vec binary")


def far_apart(x: np.ndarray, most: int) -> np.ndarray:
    """Rows of ``x``, each the furthest from all before it."""
    if not len(x):
        return np.zeros(0, int)
    at, off = [0], 2 - 2 * (x @ x[0])
    while len(at) < most and off.max() > SLACK:
        at.append(int(off.argmax()))
        np.minimum(off, 2 - 2 * (x @ x[at[-1]]), out=off)
    return np.array(at)


def work_of(x: np.ndarray, pivots: np.ndarray, radius: float, scale: float) -> float:
    """The work that ``scale`` times the rows of ``x`` make with ``pivots``: pairs
    compared in cells, and rows sent, each as dear as ``ROW_COST`` pairs."""
    sent = np.zeros(len(pivots))
    for at in range(0, len(x), SLICE):
        sent += cells_of(x[at : at + SLICE], pivots, radius)[1].sum(axis=0)
    sent *= scale
    return float((sent**2).sum() + ROW_COST * (sent * np.ceil(sent / BLOCK)).sum())


def choose_pivots(reps: DataFrame, radius: float, cell: int = CELL, most: int = MAX_PIVOTS) -> dict[tuple[int, int], np.ndarray]:
    """By label and dimension, at most about one vector in ``cell``, at most
    about ``most`` altogether.

    They come from a sample of about ``4 * most`` vectors, picked by a hash of
    their ids.  Its first vectors by that hash, and those furthest apart, in
    numbers that fall by fours, are tried on the sample; the least work decides.
    """
    n = reps.count()
    share = min(1.0, 4 * most / max(1, n))
    scale = 1 << 40
    pick = F.pmod(F.xxhash64("rep"), F.lit(scale))
    sample = reps.where(pick < int(share * scale)).select("label", "dims", "rep", "vec", pick.alias("pick")).orderBy("pick", "rep").collect()
    by: dict[tuple[int, int], list[np.ndarray]] = {}
    for row in sample:
        by.setdefault((row["label"], row["dims"]), []).append(np.frombuffer(row["vec"]))
    chosen = {}
    for key, vecs in by.items():
        x = np.array(vecs)
        number = min(math.ceil(len(x) / share / cell), math.ceil(len(x) / 4))
        orders = [np.arange(len(x)), far_apart(x, number)] if number > 1 else [np.arange(1)]
        tried = []
        while number:
            tried += [x[order[:number]] for order in orders]
            number //= 4
        chosen[key] = min(tried, key=lambda p: work_of(x, p, radius, 1 / share)) if len(tried) > 1 else tried[0]
    return chosen


def cells_of(x: np.ndarray, pivots: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """The home cell of each row, and for each cell whether the row goes there."""
    near = np.maximum(0.0, 2 - 2 * (x @ pivots.T))  # squared distances
    home = near.argmin(axis=1)
    apart = np.sqrt(np.maximum(0.0, 2 - 2 * (pivots[home] @ pivots.T)))
    own = near[np.arange(len(x)), home][:, None]
    goes = near - own <= 2 * apart * radius + SLACK
    goes[np.arange(len(x)), home] = True
    return home, goes


def _dealt(pivots: dict[tuple[int, int], np.ndarray], radius: float):
    """Rows -> a row for each cell they go to, by slices, so that a task holds
    ``SLICE`` rows' distances and ``SENT`` rows of output at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups: dict[tuple[int, int], list[int]] = {}
            for i, key in enumerate(zip(batch.column("label").to_pylist(), batch.column("dims").to_pylist(), strict=True)):
                groups.setdefault(key, []).append(i)
            for key, members in groups.items():
                for start in range(0, len(members), SLICE):
                    at = np.array(members[start : start + SLICE])
                    part = batch.take(pa.array(at))
                    if key in pivots:
                        x = np.array([np.frombuffer(v) for v in part.column("vec").to_pylist()])
                        home, goes = cells_of(x, pivots[key], radius)
                        which, cell = np.nonzero(goes)
                    else:
                        home, which, cell = np.zeros(len(at), int), np.arange(len(at)), np.zeros(len(at), int)
                    for first in range(0, len(which), SENT):
                        some, to = which[first : first + SENT], cell[first : first + SENT]
                        sent = part.take(pa.array(some))
                        columns = {"label": sent.column("label"), "dims": sent.column("dims"), "cell": pa.array(to, pa.int64()), "rep": sent.column("rep"), "copies": sent.column("copies"), "home": pa.array(home[some] == to), "vec": sent.column("vec")}
                        yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


def _links(cosine: float):
    """Units (a pair of blocks of a cell) -> counts and links: ``(rep, n, other)``,
    ``other`` null in a row that counts."""
    out_names, types = ["rep", "n", "other"], [pa.int64()] * 3

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in grouped(batches, ["label", "dims", "cell", "x", "y"]):
            reps, copies, home, block = (np.array(rows[k]) for k in ("rep", "copies", "home", "block"))
            x = np.array([np.frombuffer(v) for v in rows["vec"]])
            first, second = rows["x"][0], rows["y"][0]
            left = np.flatnonzero(block == first)
            right = left if first == second else np.flatnonzero(block == second)
            count, tree, links = np.zeros(len(reps), np.int64), np.arange(len(reps)), []
            for at in range(0, len(left), 512):
                some = left[at : at + 512]
                dots = x[some] @ x[right].T
                close = dots >= cosine
                for i, j in zip(*np.nonzero(np.abs(dots - cosine) < SLACK), strict=True):  # the same answer in whatever block
                    a, b = sorted((some[i], right[j]), key=lambda k: reps[k])
                    close[i, j] = float(np.sum(x[a] * x[b])) >= cosine
                close &= reps[some][:, None] != reps[right][None, :]
                close &= home[some][:, None] | home[right][None, :]
                count[some] += close @ copies[right]
                if first != second:
                    count[right] += copies[some] @ close
                for a, row in zip(some, close, strict=True):
                    met = right[row]
                    trees, at_first = np.unique(tree[met], return_index=True)
                    for t, b in zip(trees, met[at_first], strict=True):
                        if t != tree[a]:
                            tree[tree == t] = tree[a]
                            links.append((a, b))
            made = [(int(reps[i]), int(count[i]), None) for i in np.flatnonzero(home & (count > 0))]
            made += [(int(reps[a]), 0, int(reps[b])) for a, b in links]
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made, strict=True), types, strict=True)], out_names)

    return run


def link_vectors(vectors: DataFrame, cosine: float = 0.93, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, a row for each vector.

    Vectors of one label with a cosine of ``cosine`` or more are linked;
    ``n_links`` counts a vector's links, ``component_id`` is the least id that
    links reach, ``kept`` marks it.  Null labels, and vectors that are null,
    empty, zero or hold a null or a non-finite value, link with nothing.
    Vectors of unequal length are never linked.  A null id is the least.  Rows
    that share an id and differ in label or values are vectors of their own; of
    those in one component the first by a hash of them is kept.  Equal rows are
    one vector, whose result each of them has.  Other columns are not read, so
    their names can't clash; no rows give no rows.
    """
    radius = math.sqrt(2 - 2 * cosine)
    values = F.col(f"`{vec_col}`").cast("array<double>")
    given = Rows(vectors, id_col, {"label": F.col(f"`{label_col}`").cast("long"), "values": values})
    rows = _prepared(given.frame)
    if given.repeated:
        one = F.min(F.struct("label", "dims", "digest", "vec"))
        rows = rows.groupBy("vec_id").agg(one.alias("r")).select("vec_id", "r.*")
    rows = cut(rows)
    # Proportional vectors are linked too, but as other vectors: a class is equal values.
    classes = rows.where("vec is not null").groupBy("label", "dims", "digest").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    chosen = rows.join(classes.select(F.col("rep").alias("vec_id"), "copies"), "vec_id").select("label", "dims", F.col("vec_id").alias("rep"), "copies", "vec")
    chosen = cut(chosen)
    dealt = cut(chosen.mapInArrow(_dealt(choose_pivots(chosen, radius), radius), UNIT))
    sizes = dealt.groupBy("label", "dims", "cell").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    units = (
        dealt.join(sizes, ["label", "dims", "cell"])
        .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .withColumns({"x": F.least("block", "other"), "y": F.greatest("block", "other")})
        .drop("blocks", "other")
    )
    by = ["label", "dims", "cell", "x", "y"]
    found = cut(units.repartition(*by).sortWithinPartitions(*by, "rep").mapInArrow(_links(cosine), "rep long, n long, other long"))
    counts = found.groupBy("rep").agg(F.sum("n").alias("n"))
    parts = components(found.where("other is not null"), "rep", "other").withColumnRenamed("node", "rep")
    of_class = (
        classes.join(counts, "rep", "left").join(parts, "rep", "left")
        .select("label", "dims", "digest", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component"))
    )
    # What links with nothing is in no class and doesn't meet in the join; a class of many copies is dealt out.
    linked = spread_join(rows.where("vec is not null").select("vec_id", "label", "dims", "digest"), of_class, ["label", "dims", "digest"], ["vec_id"])
    alone = rows.where("vec is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = linked.select("vec_id", "n_links", F.col("component").alias("component_id")).unionByName(alone)
    out = out.withColumn("kept", F.col("vec_id") == F.col("component_id"))
    return given.handed_out(out, "vec_id", "component_id").select("vec_id", "n_links", "component_id", "kept")
