"""Substring, line and near-duplicate dedup against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import pytest
import xxhash
from fixtures import SCHEMA, awkward, corpus, edited, prose, rows_of, vocabulary, with_clashes

from tickerlens.llm import line_templates, minmax_dedup, substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")
NULL = -(2**63)


def key_of(row) -> tuple[int, int]:
    """The id, and a hash of the text as Spark has it, which orders the texts of an id."""
    text_hash = 42 if row[1] is None else xxhash.xxh64_intdigest(row[1].encode(), 42)
    return NULL if row[0] is None else row[0], text_hash - 2**64 * (text_hash >= 2**63)


def documents(rows) -> list[tuple[tuple[int, int], str | None]]:
    return sorted({key_of(r): r[1] for r in rows}.items())


def each_row(rows, found: dict) -> list[tuple]:
    return sorted(((r[0], *found[key_of(r)]) for r in rows), key=repr)


def windows_brute(rows, window=20):
    seen, out = set(), {}
    for doc, text in documents(rows):
        words = WORD.findall(text or "")
        gone = set()
        for i in range(len(words) - window + 1):
            w = tuple(words[i : i + window])
            if w in seen:
                gone.update(range(i, i + window))
            seen.add(w)
        kept = " ".join(x for i, x in enumerate(words) if i not in gone)
        out[doc] = (len(words), len(gone), kept)
    return each_row(rows, out)


#: Ids and texts that meet in all ways: shared, null, repeated, copied under another id.
def shared_ids(seed=31):
    rng = random.Random(seed)
    words = vocabulary(rng, 3000)
    own = [prose(rng, words, 60).replace("\n", " ") for _ in range(8)]
    ids = [None, None, None, 5, 5, 5, 9, 10]
    rows = [(i, t, "en", "s", len(t)) for i, t in zip(ids, own, strict=True)]
    rows += [(7, own[4], "en", "s", 1), rows[0], rows[7], rows[7], (5, own[0] + " end", "en", "s", 1), (None, own[3], "en", "s", 1)]
    return rows + [(None, None, None, None, None), (None, "", "en", "s", 0), (5, "", "en", "s", 0), (5, None, "en", "s", 0)]


@pytest.mark.parametrize("rows", [corpus(1), corpus(2), awkward(), shared_ids()], ids=["corpus1", "corpus2", "awkward", "shared"])
@pytest.mark.parametrize("hot", [1000, 1])
def test_repeated_windows(spark, rows, hot, monkeypatch):
    monkeypatch.setattr(substring_dedup, "HOT", hot)
    docs = with_clashes(spark.createDataFrame(rows, SCHEMA))
    assert rows_of(substring_dedup.remove_repeated_windows(docs)) == windows_brute(rows)


def test_repeated_windows_inside_one_text(spark):
    rows = [(1, "a b " * 40, None, None, None), (2, "c " * 19, None, None, None), (3, "c " * 21, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(substring_dedup.remove_repeated_windows(docs)) == windows_brute(rows)


def test_held_strings_are_bounded(spark, monkeypatch):
    """Sending on early changes who finds a repeat, not what is found."""
    monkeypatch.setattr(substring_dedup, "HELD", 3)
    rows = corpus(3)
    docs = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    assert rows_of(substring_dedup.remove_repeated_windows(docs)) == windows_brute(rows)


def test_super_kmers_cover_every_window_once():
    import numpy as np

    hashes = np.random.default_rng(0).integers(0, 6, 500).astype(np.uint64)
    mini, first, n = substring_dedup.super_kmers(hashes, 20, 8)
    assert first[0] == 0 and (first[1:] == (first + n)[:-1]).all() and first[-1] + n[-1] == 481
    assert n.max() <= 13


# ------------------------------------------------------------------ lines


def lines_brute(rows, depth=3, min_tokens=4, min_docs=8, stable=0.6, long_tokens=20, long_docs=3, short_docs=64):
    lines = []
    for doc, text in documents(rows):
        for at, line in enumerate((text or "").split("\n")):
            tokens = WORD.findall(line)
            if tokens:
                lines.append((doc, at, tuple("<*>" if len(tokens) >= min_tokens and re.search("[0-9]", t) else t for t in tokens)))
    leaves = defaultdict(list)
    for doc, at, tokens in lines:
        leaves[len(tokens), tokens[:depth]].append((doc, at, tokens))
    gone = defaultdict(set)
    for found in leaves.values():
        stay = places = 0
        for column in list(zip(*(t for _, _, t in found), strict=True))[depth:]:
            if set(column) == {"<*>"}:
                continue
            places += 1
            stay += len(set(column)) == 1
        groups = defaultdict(list)
        for doc, at, tokens in found:
            groups[None if stay >= stable * places else tokens].append((doc, at))
        tokens = len(found[0][2])
        need = short_docs if tokens < min_tokens else min_docs
        for general, where in groups.items():
            if len({d for d, _ in where}) >= need:
                for doc, at in sorted(where)[1:]:
                    gone[doc].add(at)
            elif tokens >= long_tokens:  # by the very line
                exact = defaultdict(list)
                for doc, at, masked in found:
                    if general is None or masked == general:
                        exact[masked].append((doc, at))
                for same in exact.values():
                    if len({d for d, _ in same}) >= long_docs:
                        for doc, at in sorted(same)[1:]:
                            gone[doc].add(at)
    out = {}
    for doc, text in documents(rows):
        kept = text if not gone[doc] else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone[doc])
        out[doc] = (len(text.split("\n")) if text else 0, len(gone[doc]), kept)
    return each_row(rows, out)


def log_lines(seed=5, n=40):
    rng = random.Random(seed)
    words = vocabulary(rng, 3000)
    rows = []
    for i in range(n):
        lines = [prose(rng, words, 12).replace("\n", " ") for _ in range(3)]
        lines.append(f"user {rng.choice(words)} logged in from 10.0.0.{rng.randint(0, 255)} on port {rng.randint(1, 9999)}")
        lines.append(f"served by node {rng.choice(words)} of the main site today")
        if i % 3 == 0:
            lines.append("all rights reserved by the owner")
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines), "en", "s", 0))
    return rows


@pytest.mark.parametrize("rows", [corpus(4), log_lines(), awkward(), shared_ids()], ids=["corpus", "logs", "awkward", "shared"])
@pytest.mark.parametrize("min_docs", [2, 8])
def test_recurring_lines(spark, rows, min_docs):
    docs = with_clashes(spark.createDataFrame(rows, SCHEMA))
    assert rows_of(line_templates.drop_recurring_lines(docs, min_docs=min_docs)) == lines_brute(rows, min_docs=min_docs)


def test_templates_generalise_fields_and_leave_prose(spark):
    rows = log_lines()
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = {r["doc_id"]: r for r in line_templates.drop_recurring_lines(docs).collect()}
    assert sum("served by node" in r["kept_text"] for r in kept.values()) == 1
    assert sum("all rights reserved" in r["kept_text"] for r in kept.values()) == 1
    assert all(r["n_lines"] - r["n_dropped"] >= 3 for r in kept.values())


def test_outliers_break_no_template(spark):
    """Variants of a common line, a second template and foreign lines that begin alike share one leaf."""
    base = "all rights reserved by the owner of this site and its many good friends".split()
    other = "all rights reserved if you sell old cars near my house on any monday".split()
    lines = [base] * 12 + [[f"v{chr(97 + i)}" if at in (5 + i % 4, 12) else w for at, w in enumerate(base)] for i in range(5)]
    # No masked line of the second template recurs.
    lines += [[f"q{chr(97 + i)}" if at in (7, 10) else w for at, w in enumerate(other)] for i in range(9)]
    foreign = [base[:3] + [f"{chr(97 + i)}{chr(97 + at)}" for at in range(11)] for i in range(3)]
    assert {len(x) for x in lines + foreign} == {14}
    rows = [(i, " ".join(x), "en", "s", 0) for i, x in enumerate(lines + foreign)]
    dropped = {r["doc_id"]: r["n_dropped"] for r in line_templates.drop_recurring_lines(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {i for i, n in dropped.items() if not n} == {0, 17, 26, 27, 28}


def test_long_and_short_lines(spark):
    rng = random.Random(17)
    words = vocabulary(rng, 2000)
    long = " ".join(rng.choices(words, k=60))
    rows = [(i, "\n".join([prose(rng, words, 9).replace("\n", " "), *([long] if i % 10 == 3 else []), "Home", *(["Next page"] if i < 30 else []), f"page {i}", "7"]), "en", "s", 0) for i in range(70)]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = line_templates.drop_recurring_lines(docs)
    assert rows_of(out) == lines_brute(rows)
    kept = "\n".join(r["kept_text"] for r in out.collect()).split("\n")
    assert kept.count(long) == 1 and kept.count("Home") == 1 and kept.count("7") == 1 and kept.count("Next page") == 30
    assert sum(x.startswith("page ") for x in kept) == 70
    assert rows_of(line_templates.drop_recurring_lines(docs, long_docs=8, short_docs=20)) == lines_brute(rows, long_docs=8, short_docs=20)


def test_line_stage_keeps_columns(spark):
    rows = log_lines() + awkward()
    docs = with_clashes(spark.createDataFrame(rows, SCHEMA))
    out = line_templates.without_recurring_lines(docs)
    assert out.columns == docs.columns and out.count() == len(rows)
    assert {r[c] for r in out.collect() for c in docs.columns[5:]} == {"clash"}
    for r in out.where("doc_id between 20 and 30").collect():
        assert r["n_chars"] in (0, len(r["text"]))


# ------------------------------------------------------------- near copies


def near_brute(rows, n, share):
    part, whole = share
    sets = {}
    for doc, text in documents(rows):
        words = WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
        sets[doc] = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)} if words else set()
    label = {d: d for d in sets}
    ids = sorted(sets)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if sets[a] and sets[b] and whole * len(sets[a] & sets[b]) >= part * len(sets[a] | sets[b])]
    for _ in ids:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    out = lambda d: None if d[0] == NULL else d[0]
    return each_row(rows, {d: (len(sets[d]), out(label[d]), label[d] == d) for d in ids})


@pytest.mark.parametrize("rows", [corpus(6, 120), corpus(7, 120), awkward(), shared_ids()], ids=["corpus1", "corpus2", "awkward", "shared"])
@pytest.mark.parametrize("n, share, band_rows", [(3, (85, 100), 5), (5, (4, 5), 4)])
def test_near_duplicates(spark, rows, n, share, band_rows):
    docs = with_clashes(spark.createDataFrame(rows, SCHEMA))
    assert rows_of(minmax_dedup.near_duplicates(docs, n=n, share=share, rows=band_rows)) == near_brute(rows, n, share)


@pytest.mark.parametrize("block", [4, 1024])
def test_one_large_group_of_near_copies(spark, block, monkeypatch):
    """Links at all distances from the threshold; also when buckets are dealt out in blocks."""
    monkeypatch.setattr(minmax_dedup, "BLOCK", block)
    rng = random.Random(8)
    words = vocabulary(rng, 2000)
    base = prose(rng, words, 150).replace("\n", " ")
    rows = [(i, edited(rng, base, rng.choice([0.0, 0.01, 0.02, 0.03, 0.05]), words), "en", "s", 0) for i in range(90)]
    assert rows_of(minmax_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA), n=3, share=(85, 100), rows=5)) == near_brute(rows, 3, (85, 100))


def test_bands_equal_in_low_bytes_alone_lose_no_pair(spark):
    """The pair's first band has equal low bytes but another hash; band 3 is the first they share."""
    words = [f"w{i}" for i in range(100)]
    other = ["x626" if i in (15, 99) else w for i, w in enumerate(words)]
    rows = [(1, " ".join(words), "en", "s", 0), (2, " ".join(other), "en", "s", 0)]
    signature, bands = zip(*((r["signature"], r["bands"]) for r in minmax_dedup.sketches(spark.createDataFrame(rows, SCHEMA), n=3, rows=5).orderBy("doc_id").collect()), strict=True)
    assert signature[0][:5] == signature[1][:5] and [a == b for a, b in zip(*bands, strict=True)].index(True) == 3
    found = rows_of(minmax_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA), n=3, share=(85, 100), rows=5))
    assert found == near_brute(rows, 3, (85, 100)) == [(1, 98, 1, True), (2, 98, 1, False)]


def test_near_stage_keeps_columns_and_clean_rows(spark):
    rows = corpus(9) + [(900 + i, t, a, b, c) for i, (_, t, a, b, c) in enumerate(awkward())]
    docs = with_clashes(spark.createDataFrame(rows, SCHEMA))
    out = minmax_dedup.keep_first(docs, n=3, share=(85, 100), rows=5)
    assert out.columns == docs.columns
    once = {key_of(r): r for r in rows}.values()  # of rows with one id and text one stays
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(r[0] for r in near_brute(once, 3, (85, 100)) if r[3])
    assert {r[c] for r in out.collect() for c in docs.columns[5:]} == {"clash"}


def test_stages_work_row_by_row_where_ids_are_shared_or_null(spark):
    rng = random.Random(12)
    words = vocabulary(rng, 3000)
    own = [prose(rng, words, 40).replace("\n", " ") for _ in range(8)]
    line = "all rights reserved by the owner"
    ids = [None, None, None, None, 5, 5, 5, 9]
    lined = [(i, f"{t}\n{line}", "en", "s", 0) for i, t in zip(ids, own, strict=True)]
    out = line_templates.without_recurring_lines(with_clashes(spark.createDataFrame(lined, SCHEMA))).collect()
    assert sorted(r["text"].split("\n")[0] for r in out) == sorted(own)
    assert sorted(map(str, (r["doc_id"] for r in out))) == sorted(map(str, ids))
    assert sum(line in r["text"] for r in out) == 1
    # Copies under another id, a repeated row, near copies without ids: each text stays once.
    rows = [(i, t, "en", "s", 0) for i, t in zip(ids, own, strict=True)]
    rows += [(1, own[5], "en", "s", 0), rows[7], rows[0], (None, own[1] + " end", "en", "s", 0), (None, "", "en", "s", 0), (None, "", "en", "s", 0)]
    kept = minmax_dedup.keep_first(with_clashes(spark.createDataFrame(rows, SCHEMA)))
    texts = [r["text"].removesuffix(" end") for r in kept.collect()]
    assert sorted(texts) == sorted([*own, "", ""])


def test_row_keys_are_in_the_order_of_ids(spark):
    from tickerlens.llm.common import rows_of_texts

    rows = [(i, t, None, None, None) for i in (2**63 - 1, 3, -7, None) for t in ("a", "b", None)]
    keyed = rows_of_texts(spark.createDataFrame(rows + rows[:2], SCHEMA))
    keys = {(r["id"], r["text"]): r["key"] for r in keyed.frame.collect()}
    assert keyed.made and keyed.repeated and len(set(keys.values())) == 12 and keyed.frame.count() == 14
    assert [i for i, _ in sorted(keys, key=keys.get)] == sorted(i for i, _ in keys)
    plain = rows_of_texts(spark.createDataFrame([(4, "a", None, None, None), (None, "a", None, None, None)], SCHEMA))
    assert not plain.made and {(r["key"], r["id"]) for r in plain.frame.collect()} == {(4, 4), (NULL, NULL)}


def test_min_max_estimates_are_unbiased():
    import numpy as np

    rng = np.random.default_rng(3)
    factors = minmax_dedup.factors(60)
    errors = []
    for _ in range(60):
        pool = rng.integers(0, 2**63, 300).astype(np.uint64)
        a, b = pool[:250], pool[50:]
        errors.append((minmax_dedup.min_max(a, factors) == minmax_dedup.min_max(b, factors)).mean() - 200 / 300)
    assert abs(np.mean(errors)) < 0.02


@pytest.mark.parametrize("operator", [substring_dedup.remove_repeated_windows, line_templates.drop_recurring_lines, minmax_dedup.near_duplicates, line_templates.without_recurring_lines, minmax_dedup.keep_first])
def test_empty_table(spark, operator):
    assert operator(spark.createDataFrame([], SCHEMA)).collect() == []
