"""Embedding whitening with MLlib's distributed block matrices.

Entries are whole numbers, x = floor(64 c) + 1,000,000, so counts and sums over
the corpus are exact.  Three matrices do the work:

* A, the centred rows of the distinct vectors, in blocks of ``BLOCK`` rows.  A
  transposed times A is the scatter; it alone comes to the driver, a square of
  the vectors' dimension, where ``eigh`` takes its eigenvectors;
* P, the whitening matrix: the first eigenvectors over the square roots of
  their eigenvalues, one block;
* B, the centred rows of all vectors.  B times P are the whitened vectors.  A
  times P, transposed and multiplied with itself, is their covariance, and so
  the measure of what was reached.

Tasks number their blocks, and sums over the tasks before make the numbers
block rows.  Distinct vectors are found by their whole values, with partial
results before the shuffle, so copies of one vector cost a row a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerlens.llm.common import cut

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
#: Rows of a matrix block.
BLOCK = 1024
#: Entries are told to one unit below this; sums over a block stay in 64 bits.
ENTRY_LIMIT = 2.0**52
#: Widths of a stored entry, narrowest first.
KINDS = ("<i2", "<i4", "<i8")

PARTS = "dims int, part int, k long, ids array<long>, kind int, entries binary"
RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
BLOCKS = T.StructType([
    T.StructField("at", T.StructType([T.StructField("row", T.LongType()), T.StructField("col", T.LongType())])),
    T.StructField("matrix", MatrixUDT()),
])
_AT = pa.struct([("row", pa.int64()), ("col", pa.int64())])
_MATRIX = pa.struct([
    ("type", pa.int8()), ("numRows", pa.int32()), ("numCols", pa.int32()), ("colPtrs", pa.list_(pa.int32())),
    ("rowIndices", pa.list_(pa.int32())), ("values", pa.list_(pa.float64())), ("isTransposed", pa.bool_()),
])


def _kind_of(y: np.ndarray) -> np.ndarray:
    """For each row, the narrowest of ``KINDS`` that holds it."""
    low, high = y.min(axis=1), y.max(axis=1)
    fits = [(low >= np.iinfo(k).min) & (high <= np.iinfo(k).max) for k in KINDS]
    return np.argmax(fits, axis=0)


def _entries(raw: bytes, kind: int, dims: int) -> np.ndarray:
    """Rows of floor(64 c) as 64-bit numbers."""
    return np.frombuffer(raw, KINDS[kind]).reshape(-1, dims).astype(np.int64)


class _Blocks:
    """Rows by dimension, handed out as blocks numbered within the task."""

    def __init__(self):
        self.part = TaskContext.get().partitionId()
        self.held: dict[int, list[tuple[list, np.ndarray]]] = {}
        self.next: dict[int, int] = {}

    def _made(self, dims: int, ids: list, y: np.ndarray) -> tuple:
        k = self.next.get(dims, 0)
        self.next[dims] = k + 1
        kind = int(_kind_of(y).max())
        return dims, self.part, k, ids, kind, y.astype(KINDS[kind]).tobytes()

    def add(self, ids: list, y: np.ndarray, last: bool = False) -> Iterator[tuple]:
        held = self.held.setdefault(y.shape[1], [])
        held.append((ids, y))
        if last or sum(len(part) for _, part in held) >= BLOCK:
            ids, y = sum((i for i, _ in held), []), np.concatenate([part for _, part in held])
            full = len(y) if last else len(y) // BLOCK * BLOCK
            for at in range(0, full, BLOCK):
                yield self._made(y.shape[1], ids[at : at + BLOCK], y[at : min(full, at + BLOCK)])
            self.held[y.shape[1]] = [(ids[full:], y[full:])] if full < len(y) else []

    def rest(self) -> Iterator[tuple]:
        for dims, held in list(self.held.items()):
            if held:
                yield from self.add([], np.empty((0, dims), np.int64), last=True)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.binary()]
    columns = list(zip(*rows, strict=True)) or [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["dims", "part", "k", "ids", "kind", "entries"])


def _valid(values: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """By length: the rows of the batch that are vectors of it, and floor(64 c)."""
    lengths = np.array([n or 0 for n in values.value_lengths().to_pylist()], np.int64)
    flat = values.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # a null entry is no number
    starts = np.r_[0, lengths.cumsum()[:-1]]
    for dims in np.unique(lengths[lengths > 0]):
        at = np.flatnonzero(lengths == dims)
        with np.errstate(over="ignore", invalid="ignore"):
            y = np.floor(flat[starts[at][:, None] + np.arange(dims)] * SCALE)
            fine = (np.abs(y) < ENTRY_LIMIT).all(axis=1)  # false for what is not finite
        if fine.any():
            yield at[fine], y[fine].astype(np.int64)


def _row_blocks(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = _Blocks()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for at, y in _valid(batch.column(1)):
                if made := list(blocks.add([ids[i] for i in at], y)):
                    yield _batch(made)
        yield _batch(list(blocks.rest()))

    return vectors.select(F.col(id_col).cast("long"), F.col(vec_col).cast("array<double>")).mapInArrow(run, PARTS)


def _distinct_blocks(rows: DataFrame) -> DataFrame:
    """Blocks of the distinct vectors, without ids."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dims, kind, raw in zip(*(batch.column(c).to_pylist() for c in ("dims", "kind", "entries")), strict=True):
                y = _entries(raw, kind, dims)
                own = _kind_of(y)
                for k in np.unique(own):
                    part = y[own == k].astype(KINDS[k])
                    values = pa.FixedSizeBinaryArray.from_buffers(pa.binary(part.itemsize * dims), len(part), [None, pa.py_buffer(part.tobytes())])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), dims), pa.int32()), pa.array(np.full(len(part), k), pa.int32()), values.cast(pa.binary())], ["dims", "kind", "key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = _Blocks()
        for batch in batches:
            shapes = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            raws = batch.column(2).to_pylist()
            for dims, kind in set(shapes):
                y = _entries(b"".join(r for r, s in zip(raws, shapes, strict=True) if s == (dims, kind)), kind, dims)
                if made := list(blocks.add([], y)):
                    yield _batch(made)
        yield _batch(list(blocks.rest()))

    return rows.mapInArrow(keys, "dims int, kind int, key binary").distinct().mapInArrow(run, PARTS)


def _numbered(blocks: DataFrame) -> DataFrame:
    """With ``row``, the block's place among all of its dimension."""
    parts = blocks.groupBy("dims", "part").agg(F.count("*").alias("n"))
    before = W.partitionBy("dims").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    base = parts.select("dims", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))  # a row a task
    return blocks.join(base, ["dims", "part"]).withColumn("row", F.col("base") + F.col("k")).drop("base")


def _sums(fit: DataFrame) -> dict[int, tuple[int, int, list[int]]]:
    """By dimension: vectors, blocks, and the exact sums of floor(64 c)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(d, _entries(raw, kind, d)) for d, kind, raw in zip(*(batch.column(c).to_pylist() for c in ("dims", "kind", "entries")), strict=True)]
            columns = [pa.array([d for d, _ in rows], pa.int32()), pa.array([len(y) for _, y in rows], pa.int64()), pa.array([y.sum(axis=0).tolist() for _, y in rows], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["dims", "n", "sums"])

    of_blocks = fit.mapInArrow(run, "dims int, n long, sums array<long>")
    whole = {r["dims"]: r for r in of_blocks.groupBy("dims").agg(F.sum("n").alias("n"), F.count("*").alias("blocks")).collect()}
    sums: dict[int, list[int]] = {d: [0] * d for d in whole}  # a number a dimension
    entries = of_blocks.select("dims", F.posexplode("sums").alias("at", "value"))
    for r in entries.groupBy("dims", "at").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect():
        sums[r["dims"]][r["at"]] = int(r["value"])
    return {d: (r["n"], r["blocks"], sums[d]) for d, r in whole.items()}


def deviations(y: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exact: 64-bit numbers if they hold it, else Python's."""
    most = max(int(np.abs(y).max(initial=0)), 1) * n + max(map(abs, sums), default=0)
    if most < 2**62:
        return y * n - np.array(sums, np.int64)
    return y.astype(object) * n - np.array(sums, object)


def squares(d: np.ndarray) -> list[int | None]:
    """The sum of each row's squares; null beyond 64 bits."""
    most = max(abs(int(d.max(initial=0))), abs(int(d.min(initial=0))))
    if most * most * d.shape[1] < 2**63:
        return (d.astype(np.int64) ** 2).sum(axis=1).tolist()
    return [s if s < 2**63 else None for s in (d.astype(object) ** 2).sum(axis=1)]


def _block_matrix(blocks: DataFrame, dims: int, n: int, count: int, sums: list[int]) -> BlockMatrix:
    """The centred rows; a last block is filled up with rows of zeros."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, matrices = [], []
            for row, kind, raw in zip(*(batch.column(c).to_pylist() for c in ("row", "kind", "entries")), strict=True):
                values = np.zeros((BLOCK, dims))
                d = deviations(_entries(raw, kind, dims), n, sums)
                values[: len(d)] = d / n
                places.append({"row": row, "col": 0})
                matrices.append(_dense(values))
            yield pa.RecordBatch.from_arrays([pa.array(places, _AT), pa.array(matrices, _MATRIX)], ["at", "matrix"])

    return _wrapped(blocks.select("row", "kind", "entries").mapInArrow(run, BLOCKS), BLOCK, dims, count * BLOCK, dims)


def _dense(values: np.ndarray) -> dict:
    return {"type": 1, "numRows": values.shape[0], "numCols": values.shape[1], "colPtrs": None, "rowIndices": None, "values": values.T.reshape(-1), "isTransposed": False}


def _wrapped(blocks: DataFrame, block_rows: int, block_cols: int, rows: int, cols: int) -> BlockMatrix:
    """MLlib takes blocks as a frame, so they need not become Python rows."""
    return BlockMatrix(callMLlibFunc("createBlockMatrix", blocks, block_rows, block_cols, rows, cols), block_rows, block_cols)


def _square(m: BlockMatrix, splits: int) -> np.ndarray:
    """``m`` transposed times ``m``.  The one block of the result is summed
    over ``splits`` tasks, where a plain product would make it in one."""
    made = m.transpose()._java_matrix_wrapper.call("multiply", m._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(made, m.colsPerBlock, m.colsPerBlock).toLocalMatrix().toArray()


def whitening_matrix(covariance: np.ndarray, components: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """Columns that whiten, and the shares of the variance they explain.  A
    direction without variance, as far as double precision tells, is a column
    of zeros.  Of an eigenvector's two signs the one whose largest entry (the
    first of several) is positive is taken."""
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    total = float(np.trace(covariance))
    some = values > len(covariance) * np.finfo(float).eps * total
    matrix = np.where(some, vectors / np.sqrt(np.where(some, values, 1.0)), 0.0)
    return matrix, np.where(some, values / (total or 1.0), 0.0)


def _placed(rows: DataFrame, projected: DataFrame, dims: int, n: int, sums: list[int], shares: np.ndarray, error: float) -> DataFrame:
    """Blocks with their ids, and the whitened blocks, as rows of the result."""
    m = len(shares)
    names = [f.split()[0] for f in RESULT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, kind, raw, values in zip(*(batch.column(c).to_pylist() for c in ("ids", "kind", "entries")), batch.column("values"), strict=True):
                deviation = squares(deviations(_entries(raw, kind, dims), n, sums))
                white = values.values.to_numpy().reshape(m, BLOCK)[:, : len(ids)].T.reshape(-1)
                columns = [
                    pa.array([i for i in ids for _ in range(m)], pa.int64()), pa.array(np.tile(np.arange(1, m + 1), len(ids)), pa.int32()),
                    pa.array(np.full(len(white), n), pa.int64()), pa.array([d for d in deviation for _ in range(m)], pa.int64()),
                    pa.array(white, mask=np.tile(shares == 0, len(ids))), pa.array(np.tile(shares, len(ids))), pa.array(np.full(len(white), error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    return rows.join(projected, "row").select("ids", "kind", "entries", "values").mapInArrow(run, RESULT)


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained,
    identity_error)``, a row for each vector and component.

    Null and empty vectors, and those that hold a null, a non-finite entry or
    one of 2**46 or more (floor(64 c) is not told to one unit there), are left
    out.  Vectors of unequal length are whitened by length, each with its own
    ``n``.  Rows that repeat, share an id or have a null one keep a row each;
    the fit takes each distinct vector once.  There are as many components as
    dimensions, ``components`` at most; equal eigenvalues go by the solver.  A
    component without variance (fewer distinct vectors than dimensions, or a
    single one) has a null ``whitened`` and explains 0.  ``deviation`` is null
    where it is beyond 64 bits.  Other columns are not read, so their names
    can't clash.  An empty table gives no rows.
    """
    rows = cut(_numbered(cut(_row_blocks(vectors, id_col, vec_col))))
    fit = cut(_numbered(cut(_distinct_blocks(rows))))
    spark = vectors.sparkSession
    counted = {r["dims"]: r["n"] for r in rows.groupBy("dims").agg(F.count("*").alias("n")).collect()}
    out = spark.createDataFrame([], RESULT)
    for dims, (n, blocks, sums) in sorted(_sums(fit).items()):
        splits = max(1, min(blocks, int(spark.conf.get("spark.sql.shuffle.partitions"))))
        a = _block_matrix(fit.where(F.col("dims") == dims), dims, n, blocks, sums)
        matrix, shares = whitening_matrix(_square(a, splits) / n, components)
        place = T.StructType([T.StructField("row", T.LongType()), T.StructField("values", T.ArrayType(T.DoubleType()))])
        whitener = _wrapped(_one_block(spark, matrix), dims, matrix.shape[1], dims, matrix.shape[1])
        some = shares > 0
        reached = _square(a.multiply(whitener), splits) / n
        error = float(np.abs((reached - np.eye(len(reached)))[np.ix_(some, some)]).max(initial=0.0))
        here = rows.where(F.col("dims") == dims)
        white = _block_matrix(here, dims, n, counted[dims], sums).multiply(whitener)
        made = callMLlibFunc("getMatrixBlocks", white._java_matrix_wrapper._java_model)
        out = out.union(_placed(here, made.mapInArrow(_values, place), dims, n, sums, shares, error))
    return out


def _one_block(spark, matrix: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([{"row": 0, "col": 0}] * batch.num_rows, _AT), pa.array([_dense(matrix)] * batch.num_rows, _MATRIX)], ["at", "matrix"])

    return spark.range(0, 1, 1, 1).mapInArrow(run, BLOCKS)


def _values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0).field(0).cast(pa.int64()), batch.column(1).field("values")], ["row", "values"])
