"""Helpers that several corpus operators share.

Words are runs of characters other than the six ASCII blanks.  Because those
blanks are exactly what ``bytes.split()`` cuts at, tasks that run Python work
on UTF-8 bytes and never need a regular expression to find words.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerlens.session import checkpoint_root, session_conf

BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
#: Stands for a null id inside a job, so that ids can be join keys; sorts first.
NULL_ID = -(2**63)
#: Tasks over which a join deals the rows of one hot key.
SALTS = 32
HOT_SHARE = 512

U64 = np.uint64


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, ``spark.checkpoint.dir``, which driver
    and executors share; only a local session without one (a test) gets its own."""
    return checkpoint_root(spark)


def freed(spark: SparkSession):
    """While this lasts, what the shuffles of a job wrote is removed when the job
    ends, and not when the driver next collects its garbage, until when all jobs
    of an operator would add up on the disks. For jobs run once."""
    return session_conf(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there; the
    shuffles that made it are gone."""
    shared_folder(df.sparkSession)
    with freed(df.sparkSession):
        # A frame keeps the setting under which it was made, so a new one is made here.
        return df.select("*").checkpoint(eager=True)


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def id_in(column: str | Column) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("long"), F.lit(NULL_ID))


def id_out(column: Column) -> Column:
    return F.when(column != NULL_ID, column)


class Rows:
    """The rows of a table under a key of their own.

    ``frame`` has ``key``, ``id`` (``NULL_ID`` for null), what ``values`` named
    and, if ``whole``, the row itself as one struct ``row``, so that no column
    of it can clash.  Rows share a key only if their ids and values are equal;
    keys are in the order of ids, and among the rows of one id of a hash of
    their values.  Where ids are unique, which is counted first on hashes, the
    key is the id.  ``repeated`` tells whether some key has several rows, and
    ``made`` whether keys are other than the ids.
    """

    def __init__(self, df: DataFrame, id_col: str, values: dict[str, Column], hashed: list[str] | None = None, whole: bool = False):
        parts = [id_in(F.col(f"`{id_col}`")).alias("id"), *(c.alias(n) for n, c in values.items())]
        if whole:
            parts.append(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"))
        rows, by = df.select(*parts), hashed or list(values)
        marks = [F.xxhash64(*by).alias("_a"), F.xxhash64(F.lit(1), *by).alias("_b")]
        found = rows.select("id", *marks).groupBy("id").agg(F.count("*").alias("n"), *(f(c).alias(f"{f.__name__}{c}") for c in ("_a", "_b") for f in (F.min, F.max)))
        differ = (F.col("min_a") != F.col("max_a")) | (F.col("min_b") != F.col("max_b"))
        with freed(df.sparkSession):
            told = found.agg(F.max("n").alias("most"), F.max(differ).alias("differ")).first()
        self.repeated, self.made = (told["most"] or 0) > 1, bool(told["differ"])
        if not self.made:
            self.frame = rows.select(F.col("id").alias("key"), *rows.columns)
            return
        order = ["id", "_a", "_b"]
        keys = rows.select("id", *marks).distinct().repartitionByRange(*order).sortWithinPartitions(*order)
        keys = cut(keys.withColumn("key", F.monotonically_increasing_id()))
        self.frame = rows.withColumns({"_a": marks[0], "_b": marks[1]}).join(keys, order).select("key", *rows.columns)

    def documents(self) -> DataFrame:
        """``(doc_id, text)`` by key, each once, spread by it."""
        return self.frame.groupBy(F.col("key").alias("doc_id")).agg(F.min("text").alias("text"))

    def handed_out(self, found: DataFrame, key: str, refers: str | None = None) -> DataFrame:
        """``found``, one row for each ``key``, as rows of the table: ids for
        keys, also in the column ``refers``, and rows as often as they repeat."""
        if not self.made and not self.repeated:
            out = found
        else:
            ids = self.frame.select(F.col("key").alias("_key"), F.col("id").alias("_id"))
            if refers and self.made:
                named = ids.dropDuplicates(["_key"]).withColumnsRenamed({"_key": refers, "_id": "_refers"})
                own = found.where(F.col(refers) == F.col(key)).withColumn("_refers", F.lit(None).cast("long"))
                others = spread_join(found.where(F.col(refers) != F.col(key)), named, [refers], [key]).select(*own.columns)
                found = own.unionByName(others)
            out = found.join(ids, found[key] == ids["_key"]).withColumn(key, F.col("_id"))
            if refers and self.made:
                out = out.withColumn(refers, F.coalesce("_refers", "_id"))
            out = out.select(*(c for c in found.columns if c != "_refers"))
        return out.withColumns({c: id_out(F.col(c)) for c in (key, refers) if c})


def rows_of_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", whole: bool = False) -> Rows:
    return Rows(df, id_col, {"text": F.col(f"`{text_col}`").cast("string")}, whole=whole)


def words_of(text: str | bytes | None) -> list[bytes]:
    if not text:
        return []
    return (text if isinstance(text, bytes) else text.encode()).split()


class Memo(dict):
    """``make(key)`` remembered, for at most ``limit`` keys at a time.

    Keys are in two halves.  When the newer one is full it becomes the older,
    and what the older held is forgotten; a key met again in time moves to the
    newer half, so that common keys stay."""

    def __init__(self, make, limit: int = 400_000):
        super().__init__()
        self.make, self.half, self.older = make, max(1, limit // 2), {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.half:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


#: Base of the polynomial word hash, and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 2**64)
AT_ONCE = 1 << 20


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.cumprod(np.full(n, x, U64)) for x in (BASE, INVERSE))


def _hash_joined(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Ends in ``raw``, and hashes, of its words; ``raw`` ends with a blank."""
    b = np.frombuffer(raw, np.uint8)
    blank = (b == 32) | ((b >= 9) & (b <= 13))
    starts = np.flatnonzero(~blank & np.r_[True, blank[:-1]])
    ends = np.flatnonzero(blank & np.r_[False, ~blank[:-1]])
    up, down = _powers(1 << max(AT_ONCE, len(b)).bit_length())
    sums = np.cumsum((b.astype(U64) + U64(1)) * up[: len(b)])
    before = np.where(starts > 0, sums[starts - 1], U64(0))
    return ends, mix((sums[ends - 1] - before) * down[starts] ^ (ends - starts).astype(U64) * U64(INVERSE))


def word_hashes(texts: list[bytes | None]) -> list[np.ndarray]:
    """For each text the 64-bit hashes of its words: a polynomial in the bytes
    of a word, taken from prefix sums over many texts at once."""
    out: list[np.ndarray] = []
    held: list[bytes] = []
    size = 0

    def flush() -> None:
        nonlocal size
        ends, hashes = _hash_joined(b" ".join([*held, b""]))
        cuts = np.searchsorted(ends, np.cumsum([len(t) + 1 for t in held]) - 1, side="right")
        out.extend(np.split(hashes, cuts[:-1]))
        held.clear()
        size = 0

    for text in texts:
        held.append(text or b"")
        size += len(held[-1]) + 1
        if size > AT_ONCE:
            flush()
    if held:
        flush()
    return out


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values: a fixed invertible scrambling."""
    h = h ^ (h >> U64(31))
    h = h * U64(0x9E3779B97F4A7C15)
    h ^= h >> U64(29)
    h *= U64(0xBF58476D1CE4E5B9)
    return h ^ (h >> U64(32))


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """One hash for each run of ``n`` consecutive word hashes (order counts)."""
    if len(h) < n:
        return np.empty(0, U64)
    size = len(h) - n + 1
    out = h[:size].copy()
    for i in range(1, n):
        out *= U64(0x9FB21C651E98DF25)
        out += h[i : i + size]
    return mix(out)


def signed(h: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(h).view(np.int64)


def binary(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """A string column as UTF-8 bytes, without decoding."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind)


def raw_texts(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    return binary(column).to_pylist()


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[dict[str, list]]:
    """Runs of rows with equal ``keys``, from batches sorted by them, as
    columns of Python values.  Holds one run and one batch at a time."""
    held: dict[str, list] | None = None
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = {n: batch.column(n).to_pylist() for n in batch.schema.names}
        key_rows = list(zip(*(columns[k] for k in keys), strict=True))
        start = 0
        for i in range(len(key_rows) + 1):
            if i < len(key_rows) and key_rows[i] == key_rows[start]:
                continue
            part = {n: c[start:i] for n, c in columns.items()}
            if held is not None and key_rows[start] == last:
                for n, c in part.items():
                    held[n] += c
            else:
                if held is not None:
                    yield held
                held, last = part, key_rows[start]
            start = i
            if i == len(key_rows):
                break
    if held is not None:
        yield held


def spread_join(rows: DataFrame, small: DataFrame, keys: list[str], by: list[str], how: str = "inner") -> DataFrame:
    """``rows`` joined with ``small``, one row a key, which is repeated for
    ``SALTS`` salts; rows of a hot key are dealt over as many tasks, by a hash
    of their columns ``by``."""
    small = small.withColumn("_salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64(*by), F.lit(SALTS)).cast("int"))
    return rows.join(small, [*keys, "_salt"], how).drop("_salt")


class Forest:
    """Union-find over 0..n-1, for what one task sees."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        if i == j:
            return False
        self.parent[max(i, j)] = min(i, j)
        return True


def components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """``(node, component)`` for every node that has an edge; ``component`` is
    the least node reachable.

    Alternates the large-star and small-star steps until nothing moves; each
    step is one aggregation and one join, and what it made is checkpointed.
    Stars shrink towards their least node, so the rounds grow with the
    logarithm of the size of a component, not with its diameter.  Self loops
    and null ends are ignored.

    Edges of a hot node, one with over a ``HOT_SHARE``-th of all edges, don't
    move to one task: fewer than ``2 * HOT_SHARE`` nodes can be hot, so what
    they point at is broadcast.
    """

    def ordered(df: DataFrame) -> DataFrame:
        return df.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    now = cut(ordered(edges.select(F.col(src).alias("a"), F.col(dst).alias("b"))))

    def print_of(df: DataFrame):
        with freed(df.sparkSession):
            return df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    def pointing(edges: DataFrame, by: str, least: DataFrame, n: int) -> DataFrame:
        """``edges`` with ``m`` of their node ``by``, from ``least`` ``(by, m, degree)``."""
        hot = F.broadcast(least.where(F.col("degree") * HOT_SHARE > n).select(by, "m"))
        rest = edges.join(hot.select(by), by, "left_anti").join(least.where(F.col("degree") * HOT_SHARE <= n).select(by, "m"), by)
        return rest.unionByName(edges.join(hot, by))

    before = print_of(now)
    while before[0]:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("degree")).select("a", F.least("a", "m").alias("m"), "degree")
        # Large star: each larger neighbour of a node points at the least one.
        large = ordered(pointing(now, "b", least.withColumnRenamed("a", "b"), before[0]).select("a", F.col("m").alias("b")))
        # Small star: what a node points at points at the least of those.
        low = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("degree"))
        small = pointing(large, "a", low, before[0]).select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = cut(ordered(small.union(low.select("a", F.col("m").alias("b")))))
        after = print_of(now)
        if after == before:
            break
        before = after
    leaves = now.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")
    roots = now.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return leaves.union(roots)
