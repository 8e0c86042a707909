"""Near-duplicate documents by min-max hashing.

Each of ``PERMUTATIONS`` hash functions is evaluated once per shingle and
gives two signature values, the least and the greatest: both agree between two
sets with probability equal to their Jaccard similarity, so half the hashing
fills a signature, and its estimate varies less than that of as many minima
from the same functions.  The values are cut into bands; sets that agree on a
band share a bucket.  A pair at the threshold shares none with probability
2e-7 at 0.8 and 30 bands of 4 values, 8e-7 at 0.85 and 24 bands of 5.

Texts with equal word sequences are one class before anything else.  In a
bucket, classes are compared by one-byte signatures; a pair whose estimate
comes near the threshold is checked on the full sets in the first bucket that
it shares, and nowhere else; whole band hashes tell which that is, since bands
may agree in the signatures' bytes alone.  Tasks return the links that join
what was apart (at most one fewer than their classes), never lists of pairs.  A bucket larger
than ``BLOCK`` is dealt out as pairs of blocks, so none is gathered whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerlens.llm.common import U64, Forest, Rows, components, cut, gram_hashes, grouped, id_in, mix, raw_texts, rows_of_texts, spread_join, word_hashes

PERMUTATIONS = 60
ROWS = 4
BLOCK = 1024
#: Below the threshold by five standard errors of the estimate.
MARGIN = 0.18
SEED = 20_140_801
#: Shingles of one text that are hashed in one step.
AT_ONCE = 1 << 14


def lowered(raw: bytes | None) -> bytes:
    return (raw or b"").lower()  # of bytes, it changes A-Z alone


def shingle_set(hashes: np.ndarray, n: int) -> np.ndarray:
    """Distinct shingles of words as sorted 64-bit hashes; fewer words than ``n`` are one."""
    return np.unique(gram_hashes(hashes, min(n, len(hashes)))) if len(hashes) else hashes


def factors(permutations: int) -> np.ndarray:
    """Odd multipliers, one for each hash function, from a fixed seed."""
    return mix(np.arange(1, permutations + 1, dtype=U64) * U64(SEED)) | U64(1)


def min_max(shingles: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """Least and greatest value of each hash function, least ones first."""
    least, most = [], []
    for at in range(0, len(shingles), AT_ONCE):
        part = shingles[at : at + AT_ONCE]
        values = (part ^ (part >> U64(32)))[None, :] * multipliers[:, None]
        values >>= U64(24)  # the high bits depend on all of a shingle's bits
        least.append(values.min(axis=1))
        most.append(values.max(axis=1))
    return np.concatenate([np.min(least, axis=0), np.max(most, axis=0)])


def _digest(text: bytes) -> bytes:
    return hashlib.blake2b(b" ".join(text.split()), digest_size=16).digest()


def sketches(docs: DataFrame, n: int, permutations: int = PERMUTATIONS, rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, digest, n_shingles, signature, bands)`` for each row; the
    last two are null where there are no words.  ``signature`` has one byte
    for each value, ``bands`` one hash for each band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        multipliers = factors(permutations)
        order = np.arange(2 * permutations).reshape(2, permutations).T.reshape(-1)  # a function's two values side by side
        for batch in batches:
            digests, counts, signatures, bands = [], [], [], []
            texts = [lowered(raw) for raw in raw_texts(batch.column(1))]
            for text, hashes in zip(texts, word_hashes(texts), strict=True):
                shingles = shingle_set(hashes, n)
                digests.append(_digest(text))
                counts.append(len(shingles))
                if not len(shingles):
                    signatures.append(None)
                    bands.append(None)
                    continue
                values = min_max(shingles, multipliers)[order]
                signatures.append((values & U64(255)).astype(np.uint8).tobytes())
                parts = values[: len(values) // rows * rows].reshape(-1, rows)
                key = np.arange(len(parts), dtype=U64)
                for i in range(rows):
                    key = mix(key ^ parts[:, i])
                bands.append(key.view(np.int64))
            columns = [batch.column(0), pa.array(digests, pa.binary()), pa.array(counts, pa.int64()), pa.array(signatures, pa.binary()), pa.array(bands, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "digest", "n_shingles", "signature", "bands"])

    given = docs.select(id_in(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return given.mapInArrow(run, "doc_id long, digest binary, n_shingles long, signature binary, bands array<long>")


def _near(rows: dict[str, list], least: float) -> Iterator[tuple[float, int, int]]:
    """Pairs (estimate, i, j) of a unit whose estimate is ``least`` or more
    and whose first shared band is this unit's; across blocks where it has two."""
    signs = np.frombuffer(b"".join(rows["signature"]), np.uint8).reshape(len(rows["signature"]), -1)
    bands = np.frombuffer(b"".join(rows["bands"]), np.int64).reshape(len(signs), -1)
    block, x, y, band = np.array(rows["block"]), rows["x"][0], rows["y"][0], rows["band"][0]
    for i in range(len(signs)):
        others = np.arange(i + 1, len(signs)) if x == y else np.flatnonzero(block == y) if block[i] == x else ()
        if not len(others):
            continue
        same = signs[others] == signs[i]
        estimate = (same.mean(axis=1) - 1 / 256) / (1 - 1 / 256)
        close = np.flatnonzero(estimate >= least)
        if len(close):
            shared = bands[others[close]] == bands[i]
            for k in close[shared.argmax(axis=1) == band]:
                yield float(estimate[k]), i, int(others[k])


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
    """Units one by one, the bands of a row as bytes."""

    def packed() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                flat = batch.column("bands").flatten().to_numpy()
                fixed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(flat.nbytes // batch.num_rows), batch.num_rows, [None, pa.py_buffer(flat.tobytes())])
                yield batch.set_column(batch.schema.get_field_index("bands"), "bands", fixed)

    return grouped(packed(), ["key", "x", "y"])


UNIT = "key long, band int, x long, y long, block long, doc_id long"


def _wanted(least: float):
    """Units -> their rows that some near pair needs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "band", "x", "y", "block", "doc_id"]
        types = [pa.int64(), pa.int32(), *[pa.int64()] * 4]
        out: list[tuple] = []

        def made() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        for rows in _units(batches):
            picked = sorted({i for _, *pair in _near(rows, least) for i in pair})
            out += [tuple(rows[n][i] for n in names) for i in picked]
            if len(out) > 50_000:
                yield made()
                out.clear()
        yield made()

    return run


def _with_sets(n: int):
    """Rows with texts -> rows with full sets, where the text is the one that was sketched."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, sets, last = [], [], (None, None, None)
            for i, (raw, digest) in enumerate(zip(raw_texts(batch.column("text")), batch.column("digest").to_pylist(), strict=True)):
                if raw != last[0] or not i:
                    text = lowered(raw)
                    last = raw, _digest(text), shingle_set(word_hashes([text])[0], n).tobytes()
                if last[1] == digest:
                    keep.append(i)
                    sets.append(last[2])
            kept = batch.drop_columns(["text", "digest"]).take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(sets, pa.binary())], [*kept.schema.names, "shingles"])

    return run


def _links(least: float, share: tuple[int, int]):
    """Units with sets -> a forest of the links that hold on the full sets."""
    part, whole = share

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _units(batches):
            ids, forest, found = rows["doc_id"], Forest(len(rows["doc_id"])), []
            sets = [np.frombuffer(s, U64) for s in rows["shingles"]]
            for _, i, j in sorted(_near(rows, least), reverse=True):
                if ids[i] == ids[j] or forest.find(i) == forest.find(j):
                    continue
                a, b = sets[i], sets[j]
                if whole * min(len(a), len(b)) < part * max(len(a), len(b)):
                    continue
                both = len(np.intersect1d(a, b, assume_unique=True))
                if whole * both >= part * (len(a) + len(b) - both):
                    forest.join(i, j)
                    found.append((ids[i], ids[j]))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], ["src", "dst"])

    return run


def near_duplicates(
    docs: DataFrame, n: int = 5, share: tuple[int, int] = (4, 5), permutations: int = PERMUTATIONS, rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, a row for each row of ``docs``.

    Documents are linked where the Jaccard similarity of their sets of
    lower-cased ``n``-word shingles is ``share`` (a fraction) or more;
    ``component_id`` is the least id that links reach, ``kept`` marks it.

    Null, empty and blank texts have empty sets and are linked with nothing,
    so each stays.  Fewer than ``n`` words are one shingle.  Equal texts are
    linked.  A null id is the least.  Rows that share an id and differ in their
    texts are documents of their own; of those in one component the first by a
    hash of the text is kept.  Equal rows are one document, whose result each of
    them has.  Texts are taken whole.  Other columns are not read, so their
    names can't clash.  An empty table gives no rows.
    """
    found = rows_of_texts(docs, id_col, text_col)
    out = _components(found, n, share, permutations, rows)
    return found.handed_out(out, "doc_id", "component_id").select("doc_id", "n_shingles", "component_id", "kept")


def _components(given: Rows, n: int = 5, share: tuple[int, int] = (4, 5), permutations: int = PERMUTATIONS, rows: int = ROWS) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` by key."""
    least = share[0] / share[1] - MARGIN
    texts = given.frame.select(F.col("key").alias("doc_id"), "text")
    sketch = sketches(texts, n, permutations, rows)
    one = F.min(F.struct("digest", "n_shingles", "signature", "bands"))
    sketch = cut(sketch.groupBy("doc_id").agg(one.alias("s")).select("doc_id", "s.*"))
    classes = sketch.where("n_shingles > 0").groupBy("digest").agg(F.min("doc_id").alias("rep"))
    reps = sketch.join(classes.select("digest", F.col("rep").alias("doc_id")), ["digest", "doc_id"], "left_semi")

    banded = reps.select("doc_id", F.posexplode("bands").alias("band", "key"))
    shared = banded.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    members = banded.join(shared, "key").join(reps.select("doc_id", "signature", "bands"), "doc_id")
    blocks = F.ceil(F.col("size") / BLOCK)
    spread = members.withColumn("block", F.pmod(F.xxhash64("doc_id"), blocks)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    units = spread.withColumns({"x": F.least("block", "other"), "y": F.greatest("block", "other")})
    units = units.select("key", "band", "x", "y", "block", "doc_id", "signature", "bands")
    wanted = units.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y", "doc_id").mapInArrow(_wanted(least), UNIT)

    if given.repeated:
        texts = given.documents()
    needed = wanted.join(reps.select("doc_id", "digest", "signature", "bands"), "doc_id").join(texts, "doc_id")
    full = needed.select("key", "band", "x", "y", "block", "doc_id", "signature", "bands", "digest", "text")
    full = full.mapInArrow(_with_sets(n), UNIT + ", signature binary, bands array<long>, shingles binary")
    # In the order of ids, so that a task that is run again finds the same forest.
    full = full.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y", "doc_id")
    links = full.mapInArrow(_links(least, share), "src long, dst long")

    found = components(links).withColumnRenamed("node", "rep")
    label = classes.join(found, "rep", "left").select("digest", F.coalesce("component", "rep").alias("component"))
    # Texts without words belong to no class and don't meet in the join; a class of many copies is dealt out.
    told = spread_join(sketch.where("n_shingles > 0").select("doc_id", "n_shingles", "digest"), label, ["digest"], ["doc_id"])
    blank = sketch.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    out = told.select("doc_id", "n_shingles", F.col("component").alias("component_id")).unionByName(blank)
    return out.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **parameters) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, with their columns.

    Rows are told apart as there, which also says what nulls, empty texts and
    ties give; of rows with one id and text one stays, the least as JSON, unless
    the text is blank.  A row travels as one struct, so a column may have any
    name.  An empty table gives no rows.
    """
    given = rows_of_texts(docs, id_col, text_col, whole=True)
    gone = _components(given, **parameters).where("not kept").select(F.col("doc_id").alias("key"))
    kept = given.frame.join(gone, "key", "left_anti")
    if given.repeated:
        worded = F.col("text").rlike(r"[^\x20\x09-\x0D]")
        one = kept.where(worded).groupBy("key").agg(F.min_by("row", F.to_json("row")).alias("row")).select("row")
        kept = kept.where(F.col("text").isNull() | ~worded).select("row").unionByName(one)
    return kept.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))
