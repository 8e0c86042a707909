"""Substring dedup by super-k-mers.

A window is ``WINDOW`` consecutive words; every word under a window whose word
sequence also starts earlier is removed.  Consecutive windows that share a
minimiser (the least hash among their runs of ``GRAM`` words) travel as one
packed string, their words joined by blanks, to the minimiser's bucket, and
sorting a bucket's windows finds the equal ones exactly.

Three things keep that within bounds:

* Equal windows have equal minimisers, so a minimiser that occurs once in the
  corpus has no repeated window.  Minimisers are counted first (one hash each)
  and only windows under repeated ones are packed and sent.
* A task sends an equal packed string once.  All but its first occurrence
  there are repeats already, whatever other tasks hold, and go on as bare
  positions.  So a group of copies costs one string a task, not one a copy.
* A minimiser that occurs more than ``HOT`` times (a short common passage in
  many contexts) would make a large bucket.  Its windows travel singly, each
  to the bucket of its own hash, and those again once a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickerlens.llm.common import U64, gram_hashes, grouped, raw_texts, rows_of_texts, signed, word_hashes, words_of

WINDOW = 20
GRAM = 8
HOT = 1000
#: Words of a text that fit into the low bits of a hash; longer texts take a slower way to the same minimisers.
PLACES = 1 << 20
#: Distinct strings that a task holds before it sends them on.
HELD = 100_000
UNITS = "key long, packed binary, doc_id long, start long, n long"


def super_kmers(hashes: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimiser, first window and number of windows of each super-k-mer of a
    text.  Among equal least hashes the leftmost counts, which depends on the
    window's words alone."""
    if len(hashes) < window:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    grams = gram_hashes(hashes, gram)
    windows, width = len(hashes) - window + 1, window - gram + 1
    if len(grams) <= PLACES:
        # The least of (high bits of the hash, place) by doubling spans.
        least, span = (grams & ~U64(PLACES - 1)) | np.arange(len(grams), dtype=U64), 1
        while span * 2 <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        at = (np.minimum(least[:windows], least[width - span : width - span + windows]) & U64(PLACES - 1)).astype(np.int64)
    else:
        at = np.lib.stride_tricks.sliding_window_view(grams & ~U64(PLACES - 1), width).argmin(axis=1) + np.arange(windows)
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    return signed(grams[at[first]]), first, np.diff(np.r_[first, windows])


def _minimisers(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """``(doc_id, mini, n)``: the minimisers of each text with their runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, minis, counts = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for doc, hashes in zip(batch.column(0).to_pylist(), word_hashes(raw_texts(batch.column(1))), strict=True):
                mini, n = np.unique(super_kmers(hashes, window, gram)[0], return_counts=True)
                ids.append(np.full(len(mini), doc))
                minis.append(mini)
                counts.append(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (ids, minis, counts)], ["doc_id", "mini", "n"])

    return docs.mapInArrow(run, "doc_id long, mini long, n long")


def _pack(window: int, gram: int):
    """Texts with their repeated minimisers -> units to sort, see ``UNITS``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first: dict[tuple[int, bytes], tuple[int, int, int]] = {}  # key and string: doc, start, windows
        later: list[tuple[int, int, int]] = []

        def flush() -> pa.RecordBatch:
            rows = [(k, p, d, s, n) for (k, p), (d, s, n) in first.items()]
            # A position alone needs no bucket: any task takes it.
            rows += [(hash((d, s)), None, d, s, n) for d, s, n in later]
            first.clear()
            later.clear()
            types = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["key", "packed", "doc_id", "start", "n"])

        def add(key: int, packed: bytes, here: tuple[int, int, int]) -> bool:
            known = first.get((key, packed))
            if known is None or here < known:
                first[key, packed] = here
            if known is not None:
                later.append(max(known, here))
            return known is None

        for batch in batches:
            texts = raw_texts(batch.column("text"))
            for doc, raw, hashes, minis, hots in zip(batch.column("doc_id").to_pylist(), texts, word_hashes(texts), batch.column("minis").to_pylist(), batch.column("hots").to_pylist(), strict=True):
                hot = dict(zip(minis, hots, strict=True))
                words = words_of(raw)
                for mini, start, n in zip(*(x.tolist() for x in super_kmers(hashes, window, gram)), strict=True):
                    if mini not in hot:
                        continue
                    if not hot[mini]:
                        add(mini, b" ".join(words[start : start + n + window - 1]), (doc, start, n))
                        continue
                    for s in range(start, start + n):
                        packed = b" ".join(words[s : s + window])
                        add(xxhash.xxh3_64_intdigest(packed) - 2**63, packed, (doc, s, 1))
                if len(first) + len(later) > HELD:
                    yield flush()
        yield flush()

    return run


def _sort_buckets(window: int):
    """Buckets of units -> ``(doc_id, start, n)``: n windows, from the one at
    ``start``, that also start earlier."""

    def repeats(rows: dict[str, list]) -> Iterator[tuple[int, int, int]]:
        first: dict[bytes, tuple[int, int, int]] = {}
        for packed, *here in zip(rows["packed"], rows["doc_id"], rows["start"], rows["n"], strict=True):
            here = tuple(here)
            if packed is None:
                yield here
            elif packed not in first:
                first[packed] = here
            else:
                yield max(here, first[packed])
                first[packed] = min(here, first[packed])
        if len(first) < 2:
            return
        windows = []
        for packed, (doc, start, n) in first.items():
            words = packed.split(b" ")
            windows += [(b" ".join(words[i : i + window]), doc, start + i) for i in range(n)]
        windows.sort()
        found = sorted((d, s) for (w, d, s), before in zip(windows[1:], windows, strict=False) if w == before[0])
        i = 0
        while i < len(found):
            j = i + 1
            while j < len(found) and found[j] == (found[i][0], found[i][1] + j - i):
                j += 1
            yield *found[i], j - i
            i = j

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int, int]] = []

        def made() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [()] * 3
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "n"])

        for rows in grouped(batches, ["key"]):
            if len(rows["key"]) > 1 or rows["packed"][0] is None:
                out += repeats(rows)
                if len(out) > 50_000:
                    yield made()
                    out.clear()
        yield made()

    return run


def _remove(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            for raw, spans in zip(raw_texts(batch.column("text")), batch.column("spans").to_pylist(), strict=True):
                words = words_of(raw)
                if not spans:
                    n_words.append(len(words))
                    n_removed.append(0)
                    kept.append(b" ".join(words))
                    continue
                gone = np.zeros(len(words) + 1, np.int64)
                for span in spans:
                    gone[span["start"]] += 1
                    gone[span["start"] + span["n"] + window - 1] -= 1
                gone = gone.cumsum()[:-1] > 0
                n_words.append(len(words))
                n_removed.append(int(gone.sum()))
                kept.append(b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "kept_text"])

    return run


def remove_repeated_windows(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_text)``, a row for each row of
    ``docs``; ``kept_text`` is the words that stay, joined by one blank.

    A null text has no words, nor has an empty one; texts shorter than a
    window lose nothing.  Of equal windows the first stays, by id (null is the
    least) and then by place.  Rows that share an id and differ in their texts
    are documents of their own, in the order of a hash of the text; equal rows
    are one document, whose result each of them has.  Texts are taken whole,
    whatever their length.  Other columns are not read, so their names can't
    clash.  An empty table gives no rows.
    """
    rows = rows_of_texts(docs, id_col, text_col)
    texts = rows.documents()
    minis = _minimisers(texts, window, gram)
    # One exchange of (id, hash, number) rows; their texts stay where they are.
    total = F.sum("n").over(Window.partitionBy("mini"))
    wanted = (
        minis.withColumn("total", total).where("total > 1")
        .groupBy("doc_id").agg(F.collect_list(F.struct("mini", (F.col("total") > HOT).alias("hot"))).alias("found"))
        .select("doc_id", F.col("found.mini").alias("minis"), F.col("found.hot").alias("hots"))
    )
    # In the order of ids, so that a task that is run again sends the same again.
    todo = texts.join(wanted, "doc_id").select("doc_id", "text", "minis", "hots").sortWithinPartitions("doc_id")
    units = todo.mapInArrow(_pack(window, gram), UNITS)
    spans = units.repartition("key").sortWithinPartitions("key").mapInArrow(_sort_buckets(window), "doc_id long, start long, n long")
    by_doc = spans.groupBy("doc_id").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    kept = texts.join(by_doc, "doc_id", "left").select("doc_id", "text", "spans").mapInArrow(_remove(window), "doc_id long, n_words long, n_removed long, kept_text string")
    return rows.handed_out(kept, "doc_id")
