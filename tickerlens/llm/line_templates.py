"""Line dedup by a log-template tree of fixed depth.

A line walks down a tree by its number of tokens and then its ``DEPTH``
leading tokens, where a token that holds a digit counts as a variable field
(``<*>``).  The leaf generalises what reaches it: a position whose token is
the same in all its lines stays, one that differs becomes ``<*>``.  If at
least ``STABLE`` of the positions below the leading tokens stay, the leaf is
one template.  Otherwise it holds several, or lines that only happen to begin
alike: a token that ``MIN_DOCS`` documents have at its position stays, others
become ``<*>``, and what ``MIN_DOCS`` documents then share is a template, if
``STABLE`` of its positions stay.  A template that is as much alike to a more
frequent one joins it, and so does every other masked line of the leaf, so that
variants and foreign lines open no template and break none.  A template found
in ``MIN_DOCS`` documents or more is boilerplate: its lines are dropped but for
the first one.  A line of ``LONG_TOKENS`` tokens or more recurs by chance in no
corpus, so it is boilerplate in ``LONG_DOCS`` documents already, by its masked
tokens; one shorter than ``MIN_TOKENS`` has no shape to go by and is
boilerplate by its very words in ``SHORT_DOCS`` documents.

Generalising is "same or ``<*>``" by position, which is associative, so leaves
are aggregated like counts, with partial results before the shuffle: a leaf
with a third of all lines costs what any other does.  Only leaves that reach
``MIN_DOCS`` documents, found by counting one hash a document and leaf, have
their lines sent at all.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerlens.llm.common import SALTS, binary, cut, rows_of_texts, spread_join

DEPTH = 3
MIN_TOKENS = 4
MIN_DOCS = 8
LONG_TOKENS, LONG_DOCS = 20, 3
SHORT_DOCS = 64
STABLE = 0.6
FIELD = b"<*>"
DIGIT = re.compile(rb"[0-9]")


def masked(tokens: list[bytes]) -> list[bytes]:
    return [FIELD if DIGIT.search(t) else t for t in tokens]


def leaf_of(tokens: list[bytes], depth: int) -> int:
    """The leaf of masked tokens, as a signed hash of its path."""
    return xxhash.xxh3_64_intdigest(b"%d " % len(tokens) + b" ".join(tokens[:depth])) - 2**63


def parsed(raw: bytes | None, depth: int, min_tokens: int) -> Iterator[tuple[int, int, list[bytes]]]:
    """``(line number, leaf, masked tokens)`` of the lines with tokens; those
    too short for a template keep their digits."""
    for at, line in enumerate((raw or b"").split(b"\n")):
        if tokens := line.split():
            tokens = masked(tokens) if len(tokens) >= min_tokens else tokens
            yield at, leaf_of(tokens, depth), tokens


def _leaves(docs: DataFrame, depth: int, min_tokens: int) -> DataFrame:
    """``(doc_id, leaf, tokens)``: the distinct leaves of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, leaves, tokens = ([np.empty(0, np.int64)] for _ in range(3))
            for doc, raw in zip(batch.column(0).to_pylist(), binary(batch.column(1)), strict=True):
                own = {leaf: len(line) for _, leaf, line in parsed(raw.as_py(), depth, min_tokens)}
                ids.append(np.full(len(own), doc, np.int64))
                leaves.append(np.fromiter(own, np.int64, len(own)))
                tokens.append(np.fromiter(own.values(), np.int64, len(own)))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (ids, leaves, tokens)], ["doc_id", "leaf", "tokens"])

    return docs.mapInArrow(run, "doc_id long, leaf long, tokens long")


LINES = "doc_id long, line int, leaf long, masked string, first_in_leaf boolean, first_of_line boolean"


def _lines(depth: int, min_tokens: int):
    """Texts with their common leaves -> the lines under those, see ``LINES``.
    The flags mark a document's first line of a leaf, and of a masked line, so
    that sums of them count documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            for doc, raw, wanted in zip(batch.column("doc_id").to_pylist(), binary(batch.column("text")), batch.column("leaves").to_pylist(), strict=True):
                wanted, leaves, lines = set(wanted), set(), set()
                for at, leaf, tokens in parsed(raw.as_py(), depth, min_tokens):
                    if leaf in wanted:
                        line = b" ".join(tokens)
                        for column, value in zip(out, (doc, at, leaf, line, leaf not in leaves, line not in lines), strict=True):
                            column.append(value)
                        leaves.add(leaf)
                        lines.add(line)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.bool_(), pa.bool_()]
            columns = [pa.array(c, t) for c, t in zip(out, types, strict=True)]
            columns[3] = columns[3].cast(pa.string())
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "line", "leaf", "masked", "first_in_leaf", "first_of_line"])

    return run


def _frequent(depth: int, stable: float):
    """Masked lines -> their general form, where the tokens stay that are
    frequent at their places (``info``: "place token"); empty if too few do."""

    def prepare(info: list[str]):
        stays = {x.encode() for x in info}

        def place(masked: bytes, _: str | None) -> str:
            tokens = masked.split(b" ")
            kept = tokens[:depth] + [t if t != FIELD and b"%d %b" % (at, t) in stays else FIELD for at, t in enumerate(tokens[depth:], depth)]
            stay, places = (sum(t != FIELD for t in x[depth:]) for x in (kept, tokens))
            return b" ".join(kept).decode() if stay >= stable * places else ""

        return place

    return prepare


def _nearest(depth: int, stable: float):
    """Masked lines -> the template they belong to, of their leaf's templates
    in the order of their frequency."""

    def prepare(info: list[str]):
        numbers: dict[bytes, int] = {FIELD: 0}
        seeds = np.array([[numbers.setdefault(t, len(numbers)) for t in x.encode().split(b" ")[depth:]] for x in info], np.int64).reshape(len(info), -1)

        def alike(row: np.ndarray, among: np.ndarray) -> np.ndarray:
            equal = ((among == row) & (row != 0)).sum(axis=1)
            return np.flatnonzero(equal >= stable * ((among != 0) | (row != 0)).sum(axis=1))

        heads: list[int] = []
        head_of = {}
        for i, seed in enumerate(seeds):
            found = alike(seed, seeds[heads]) if heads else ()
            if not len(found):
                heads.append(i)
            head_of[i] = heads[found[0]] if len(found) else i
        index = {x: i for i, x in enumerate(info)}

        def place(masked: bytes, candidate: str | None) -> str | None:
            at = index.get(candidate)
            if at is None:
                row = np.array([numbers.get(t, -1) for t in masked.split(b" ")[depth:]], np.int64)
                found = alike(row, seeds)
                at = int(found[0]) if len(found) else None
            return None if at is None else info[head_of[at]]

        return place

    return prepare


def _placed(rows: DataFrame, by_leaf: DataFrame, prepare) -> DataFrame:
    """``(leaf, masked, docs, made)``: what ``prepare(info)(masked, made)``
    gives for each row, if not null, with the ``info`` that ``by_leaf`` has.
    The rows of a hot leaf are dealt over ``SALTS`` tasks; a leaf's info comes
    there once, before its rows.  Leaves without info are left out."""
    schema = "leaf long, masked string, docs long, made string"
    salts = F.explode(F.array(*map(F.lit, range(SALTS)))).alias("salt")
    rows = rows.select("leaf", F.pmod(F.xxhash64("masked"), F.lit(SALTS)).cast("int").alias("salt"), "masked", "docs", "made", F.lit(None).cast("array<string>").alias("info"))
    infos = by_leaf.select("leaf", salts, F.lit(None).cast("string").alias("masked"), F.lit(None).cast("long").alias("docs"), F.lit(None).cast("string").alias("made"), "info")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, info, place = None, None, None
        for batch in batches:
            leaves, made = batch.column("leaf").to_pylist(), []
            given = zip(leaves, binary(batch.column("masked")).to_pylist(), batch.column("made").to_pylist(), batch.column("info"), strict=True)
            for leaf, masked, candidate, told in given:
                if masked is None:
                    at, info, place = leaf, told.as_py(), None
                    made.append(None)
                elif leaf != at:
                    made.append(None)
                else:
                    place = place or prepare(info)
                    made.append(place(masked, candidate))
            keep = pa.array([m is not None for m in made], pa.bool_())
            columns = [batch.column("leaf"), batch.column("masked"), batch.column("docs"), pa.array(made, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["leaf", "masked", "docs", "made"]).filter(keep)

    dealt = rows.union(infos).repartition("leaf", "salt").sortWithinPartitions("leaf", "salt", F.col("masked").asc_nulls_first())
    return dealt.mapInArrow(run, schema)


def templates(lines: DataFrame, depth: int, min_tokens: int, min_docs: int, long_tokens: int, long_docs: int, short_docs: int, stable: float) -> DataFrame:
    """Recurring templates, as ``(leaf, masked, template, n_docs, keep)``: the
    masked lines they cover, in how many documents, and the occurrence to keep."""
    here = F.struct("doc_id", "line")
    by_line = cut(lines.groupBy("leaf", "masked").agg(F.sum(F.col("first_of_line").cast("long")).alias("docs"), F.sum(F.col("first_in_leaf").cast("long")).alias("leaf_docs"), F.min(here).alias("first")))
    tokens = by_line.select("leaf", "docs", F.posexplode(F.split("masked", " ")).alias("at", "token"))
    by_place = tokens.groupBy("leaf", "at").agg(F.min("token").alias("low"), F.max("token").alias("high"))
    same = (F.col("low") == F.col("high")) & (F.col("low") != FIELD.decode())
    field = F.col("low") == F.col("high")  # a masked field is no sign either way
    shape = F.transform(F.array_sort(F.collect_list(F.struct("at", F.when(same, F.col("low")).otherwise(FIELD.decode()).alias("token")))), lambda x: x["token"])
    below = F.col("at") >= depth
    leaves = by_place.groupBy("leaf").agg(
        F.array_join(shape, " ").alias("general"),
        F.sum((below & same).cast("long")).alias("stay"),
        F.sum((below & ~(field & ~same)).cast("long")).alias("places"),
    )
    whole = by_line.groupBy("leaf").agg(F.sum("leaf_docs").alias("all_docs"), F.min("first").alias("all_first"))
    need = F.when(F.size(F.split("general", " ")) < min_tokens, short_docs).otherwise(min_docs)
    leaves = cut(leaves.join(whole, "leaf").where(F.col("all_docs") >= need).withColumn("is_one", F.col("stay") >= stable * F.col("places")))
    one = leaves.where("is_one").select("leaf", F.col("general").alias("template"), F.col("all_docs").alias("n_docs"), F.col("all_first").alias("keep"))
    found = spread_join(by_line, one, ["leaf"], ["masked"]).select("leaf", "masked", "template", "n_docs", "keep")

    several = leaves.where("not is_one").select("leaf")
    frequent = tokens.where(below & (F.col("token") != FIELD.decode())).groupBy("leaf", "at", "token").agg(F.sum("docs").alias("n")).where(F.col("n") >= min_docs)
    info = frequent.groupBy("leaf").agg(F.collect_list(F.concat_ws(" ", F.col("at").cast("string"), "token")).alias("info"))
    info = several.join(info, "leaf", "left").select("leaf", F.coalesce("info", F.array().cast("array<string>")).alias("info"))
    varied = spread_join(by_line.select("leaf", "masked", "docs"), several, ["leaf"], ["masked"]).withColumn("made", F.lit(None).cast("string"))
    general = cut(_placed(varied, info, _frequent(depth, stable)))
    seeds = general.where("made <> ''").groupBy("leaf", "made").agg(F.sum("docs").alias("n")).where(F.col("n") >= min_docs)
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "made")))
    info = seeds.groupBy("leaf").agg(F.transform(ranked, lambda x: x["made"]).alias("info"))
    placed = cut(_placed(general, info, _nearest(depth, stable)).select("leaf", "masked", F.col("made").alias("template")))
    # A document may have several masked lines of a template and counts once.
    by_doc = spread_join(lines.select("doc_id", "line", "leaf", "masked"), placed, ["leaf", "masked"], ["doc_id"]).groupBy("leaf", "template", "doc_id").agg(F.min("line").alias("line"))
    counted = by_doc.groupBy("leaf", "template").agg(F.count("*").alias("n_docs"), F.min(here).alias("keep")).where(F.col("n_docs") >= min_docs)
    found = found.union(spread_join(placed, counted, ["leaf", "template"], ["masked"]).select("leaf", "masked", "template", "n_docs", "keep"))
    # Long lines that no template covers go by themselves.
    alone = by_line.where((F.size(F.split("masked", " ")) >= long_tokens) & (F.col("docs") >= long_docs))
    alone = alone.select("leaf", "masked", F.col("masked").alias("template"), F.col("docs").alias("n_docs"), F.col("first").alias("keep"))
    return found.union(alone.join(found.select("leaf", "masked"), ["leaf", "masked"], "left_anti"))


def _without_lines():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_lines, n_dropped, kept = [], [], []
            for raw, gone in zip(binary(batch.column("text")), batch.column("gone").to_pylist(), strict=True):
                raw = raw.as_py()
                lines = (raw or b"").split(b"\n")
                drop = set(gone or ())
                n_lines.append(len(lines) if raw else 0)
                n_dropped.append(len(drop))
                kept.append(b"\n".join(x for i, x in enumerate(lines) if i not in drop) if drop else raw)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_lines", "n_dropped", "kept_text"])

    return run


def _dropped(
    texts: DataFrame, depth: int = DEPTH, min_tokens: int = MIN_TOKENS, min_docs: int = MIN_DOCS, long_tokens: int = LONG_TOKENS, long_docs: int = LONG_DOCS,
    short_docs: int = SHORT_DOCS, stable: float = STABLE,
) -> DataFrame:
    """``(doc_id, n_lines, n_dropped, kept_text)`` of texts with unique ids."""
    leaves = _leaves(texts, depth, min_tokens)
    need = F.when(F.col("tokens") < min_tokens, short_docs).when(F.col("tokens") >= long_tokens, min(long_docs, min_docs)).otherwise(min_docs)
    common = leaves.groupBy("leaf").agg(F.count("*").alias("n"), F.max("tokens").alias("tokens")).where(F.col("n") >= need).select("leaf")
    wanted = spread_join(leaves.drop("tokens"), common, ["leaf"], ["doc_id"]).groupBy("doc_id").agg(F.collect_list("leaf").alias("leaves"))
    lines = cut(texts.join(wanted, "doc_id").select("doc_id", "text", "leaves").mapInArrow(_lines(depth, min_tokens), LINES))
    recurring = templates(lines, depth, min_tokens, min_docs, long_tokens, long_docs, short_docs, stable).select("leaf", "masked", "keep")
    found = spread_join(lines, recurring, ["leaf", "masked"], ["doc_id"])
    gone = found.where(F.struct("doc_id", "line") != F.col("keep")).groupBy("doc_id").agg(F.collect_list("line").alias("gone"))
    return texts.join(gone, "doc_id", "left").select("doc_id", "text", "gone").mapInArrow(_without_lines(), "doc_id long, n_lines long, n_dropped long, kept_text string")


def drop_recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **parameters) -> DataFrame:
    """``(doc_id, n_lines, n_dropped, kept_text)``, a row for each row of
    ``docs``; ``parameters`` as ``_dropped`` has them.

    Lines end at ``\\n``; those with fewer than ``min_tokens`` tokens have no
    template and stay.  A null text stays null and has no lines, an empty one
    too.  Of a template's occurrences the first stays, by id (null is the least)
    and line; equal lines of one document count as one document.  Rows that
    share an id and differ in their texts are documents of their own, in the
    order of a hash of the text; equal rows are one document, whose result each
    of them has.  Texts are taken whole, whatever their length.  Other columns
    are not read, so their names can't clash.  An empty table gives no rows.
    """
    rows = rows_of_texts(docs, id_col, text_col)
    return rows.handed_out(_dropped(rows.documents(), **parameters), "doc_id")


def without_recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars", **parameters) -> DataFrame:
    """``docs`` with its columns, the recurring lines taken out of the texts
    (and ``length_col``, if there is such a column, set to their length).

    Rows are told apart as in ``drop_recurring_lines``, which also says what
    nulls, empty texts and ties give.  A row travels as one struct, so a column
    may have any name.  An empty table gives no rows.
    """
    rows = rows_of_texts(docs, id_col, text_col, whole=True)
    changed = _dropped(rows.documents(), **parameters).where("n_dropped > 0").select(F.col("doc_id").alias("key"), F.col("kept_text").alias("kept"))
    joined = rows.frame.select("key", "row").join(changed, "key", "left")
    made = {text_col: F.coalesce(F.col("kept"), F.col("row").getField(text_col))}
    if length_col in docs.columns:
        length = F.length("kept").cast(docs.schema[length_col].dataType)
        made[length_col] = F.when(F.col("kept").isNull(), F.col("row").getField(length_col)).otherwise(length)
    return joined.select(*(made.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns))
