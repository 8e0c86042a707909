"""Licence scans, fill-in-middle and whitening against brute force."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
from fixtures import SCHEMA, awkward, corpus, prose, vocabulary, with_clashes

from tickerlens.llm import fill_in_middle, licence_scan, whitening

# ---------------------------------------------------------------- licences

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def licence_words(text):
    return WORD.findall((text or "").translate(LOWER))


def licences_brute(texts):
    """Every template tried at every beginning that its rarest words name."""
    docs = [licence_words(t) for t in texts]
    templates = [(label, p.split(), key.split()) for label, p, key in licence_scan.TEMPLATES]
    known = {w for _, p, _ in templates for w in p}
    counts = Counter(w for d in docs for w in set(d) & known)
    out = []
    for words in docs:
        base = [(i, label) for phrase, label in licence_scan.PHRASES for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
        labels, score = {label for _, label in base}, float(bool(base))
        for label, passage, key in templates:
            anchors = sorted(set(passage) & set(words), key=lambda w: (counts[w], w.encode()))[: licence_scan.ANCHORS]
            at = next(i for i in range(len(passage)) if passage[i : i + len(key)] == key)
            for begin in range(-len(passage), len(words)):
                agree = [w for w in anchors if any(passage[q] == w and 0 <= begin + q < len(words) and words[begin + q] == w for q in range(len(passage)))]
                here = sum(0 <= begin + q < len(words) and words[begin + q] == w for q, w in enumerate(passage))
                whole = begin + at >= 0 and words[begin + at : begin + at + len(key)] == key
                if agree and 2 * len(agree) >= len(anchors) and 10 * here >= licence_scan.SHARE * len(passage) and whole:
                    labels.add(label)
                    score = max(score, here / len(passage))
        places = [i for i, _ in base]
        out.append((len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in base})), ",".join(sorted(labels)), score))
    return out


def licence_texts():
    rng = random.Random(5)
    words = vocabulary(rng, 200) + ["license", "the", "of", "gnu", "mit", "general", "public"]
    texts = [None, "", " .,\t", "MIT License; mit_license MIT-LICENSE mitlicense apache\nLICENSE général public license general public  license"]
    for label, passage, _ in licence_scan.TEMPLATES:
        for share in (0, 0.05, 0.15, 0.4):
            made = " ".join(rng.choice(words) if rng.random() < share else w for w in passage.split())
            texts.append(f"{prose(rng, words, rng.randint(0, 30))} {made.title()}, {prose(rng, words, rng.randint(0, 30))}")
        texts.append(passage.rsplit(" ", 1)[0])
        texts.append(" ".join(passage.split()[1:]) + " " + passage)
    texts += [" ".join(["license"] * 50), "the license " * 3000 + "licensed under CC BY-NC 4.0"]
    return texts


def test_licences(spark):
    texts = licence_texts()
    rows = [(None if i % 9 == 0 else i // 2, t, None, None, None) for i, t in enumerate(texts)]
    got = licence_scan.scan_licences(with_clashes(spark.createDataFrame(rows, SCHEMA).coalesce(1))).collect()
    want = [(r[0], *x) for r, x in zip(rows, licences_brute(texts), strict=True)]
    assert [tuple(r)[:-1] for r in got] == want
    assert len({w[6] for w in want}) > 8
    for r, (_, text, *_rest) in zip(got, rows, strict=True):
        for p in r["passages"]:
            assert p["label"] in r["labels"].split(",") and 0 <= p["first_word"] + p["n_words"] and p["n_matched"] <= len(licence_words(text))


def test_licence_passage_places(spark):
    text = "x y. Licensed under the Apache License, Version 2.0 (the thing); licensed under CC BY-NC 4.0."
    row = licence_scan.scan_licences(spark.createDataFrame([(1, text, None, None, None)], SCHEMA)).first()
    assert row["base_labels"] == "apache" and row["labels"] == "apache,cc-by-nc" and (row["first_word"], row["n_base"]) == (5, 1)
    assert [(p["label"], p["first_word"], p["n_matched"]) for p in row["passages"]] == [("apache", 2, 8), ("cc-by-nc", 12, 7)]


def test_licences_of_awkward_rows(spark):
    rows = corpus(3, 12) + awkward()
    got = licence_scan.scan_licences(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r["doc_id"] or -1, r["n_words"]) for r in got) == sorted((r[0] or -1, len(licence_words(r[1]))) for r in rows)
    assert licence_scan.scan_licences(spark.createDataFrame([], SCHEMA)).collect() == []


# ---------------------------------------------------------------- fill in the middle

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def middle_brute(doc, text):
    text = text or ""
    units = UNIT.findall(text)
    digits = hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digits[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 50:
        return len(units), "plain", None, None, text
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < 80:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def middle_texts():
    rng = random.Random(11)
    made = ["".join(rng.choices("ab é\U0001f600 \t\n\x0b\x85<PSM>", k=rng.randint(0, 80))) for _ in range(300)]
    return [None, "", " ", "\n\n", "a", " a ", "<P>", "x<S>y", "<M", "<", *made, "w é " * 40_000]


def test_fill_in_middle(spark):
    rows = [(i if i % 7 else None, t, None, None, None) for i, t in enumerate(middle_texts())]
    rows += [(i, middle_texts()[-1], None, None, None) for i in range(6)] + awkward() + corpus(4, 10)
    made = fill_in_middle.fill_in_middle(with_clashes(spark.createDataFrame(rows, SCHEMA).coalesce(1)))
    got = made.withColumn("text", fill_in_middle.restored()).collect()
    assert [tuple(r)[:-1] for r in got] == [(r[0], *middle_brute(r[0], r[1])) for r in rows]
    assert [r["text"] for r in got] == [r[1] or "" for r in rows]
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    assert fill_in_middle.fill_in_middle(spark.createDataFrame([], SCHEMA)).collect() == []


def test_skip_list_finds_every_rank():
    rng = random.Random(2)
    for n in [0, 1, 2, 3, 5, 17, 400, 70_000]:
        widths = [rng.randint(1, 9) for _ in range(n)]
        ends = [0, *itertools.accumulate(widths)]
        units = fill_in_middle.SkipList(np.array(ends[1:], np.int64))
        for rank in {0, n, *(rng.randint(0, n) for _ in range(300))}:
            assert units.place(rank) == ends[rank]
        for widths, points, _ in units.lanes:
            assert widths.sum() <= n and points.sum() <= ends[-1]
        assert len(units.lanes) == 1 if n < 2 else len(units.lanes[-1][0]) <= max(8, n // 2)


# ---------------------------------------------------------------- whitening

VECTORS = "vec_id long, embedding array<float>, label int"


def whitened_brute(rows, m=16):
    """By id, in numpy: n, deviation, whitened up to the sign, explained."""
    good = [(i, np.array(v, np.float64)) for i, v, *_ in rows if v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for dims in sorted({len(v) for _, v in good}):
        ids = [i for i, v in good if len(v) == dims]
        x = np.array([np.floor(64 * v) for _, v in good if len(v) == dims]).astype(np.int64) + 1_000_000
        fit = np.unique(x, axis=0)
        n, s = len(fit), fit.sum(axis=0)
        centred = fit - s / n
        v = centred.T @ centred / n
        e, p = np.linalg.eigh(v)
        e, p = e[::-1][:m], p[:, ::-1][:, :m]
        some = e > dims * np.finfo(float).eps * np.trace(v)
        for i, row in zip(ids, x, strict=True):
            deviation = sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s, strict=True))
            for k in range(len(e)):
                white = abs(float((row - s / n) @ p[:, k] / np.sqrt(e[k]))) if some[k] else None
                out.append((i, k + 1, n, deviation, white, e[k] / np.trace(v) if some[k] else 0.0))
    return out


def check_whitened(got, want):
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2], r[3], r[4] or 0)
    got = sorted(((*tuple(r)[:4], None if r[4] is None else abs(r[4]), r[5]) for r in got), key=key)
    want = sorted(want, key=key)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    for g, w in zip(got, want, strict=True):
        assert (g[4] is None) == (w[4] is None) and (g[4] or 0) == pytest.approx(w[4] or 0, rel=1e-7, abs=1e-7)
        assert g[5] == pytest.approx(w[5], rel=1e-9, abs=1e-12)


def test_whitening(spark):
    rng = np.random.default_rng(3)
    spread = rng.normal(size=(2500, 24)) * np.linspace(4, 0.5, 24)
    rows = [(i, v.astype(np.float32).tolist(), 0) for i, v in enumerate(spread)]
    rows += [(9000 + i, rows[7][1], None) for i in range(1500)]  # copies of one vector count once
    rows += [(None, rows[8][1], 1), (3, rows[9][1], 1), (3, rows[9][1], 1)]
    rows += [(9, None, 1), (10, [], 1), (11, [float("nan")] * 24, 1), (12, [None, *[1.0] * 23], 1), (13, [float("inf")] * 24, 1)]
    docs = with_clashes(spark.createDataFrame(rows, VECTORS).repartition(7))
    got = whitening.whiten(docs).collect()
    check_whitened(got, whitened_brute(rows))
    assert {r["component"] for r in got} == set(range(1, 17)) and max(r["identity_error"] for r in got) < 1e-9
    signs = {}
    for r in got:
        if r["vec_id"] == 3:
            signs.setdefault(r["component"], set()).add(r["whitened"])
    assert all(len(s) <= 2 for s in signs.values())  # row 3 and its two further rows


def test_whitening_without_variance_and_of_several_lengths(spark):
    rng = np.random.default_rng(4)
    few = [(i, v.tolist(), 0) for i, v in enumerate(rng.normal(size=(5, 20)).astype(np.float32))]
    short = [(100 + i, v.tolist(), 0) for i, v in enumerate(rng.normal(size=(30, 3)).astype(np.float32))]
    one = [(200, [1.0, 2.0], 0), (201, [1.0, 2.0], 0)]
    got = whitening.whiten(spark.createDataFrame(few + short + one, VECTORS)).collect()
    check_whitened([r for r in got if r["vec_id"] >= 100], whitened_brute(short + one))
    of_few = [r for r in got if r["vec_id"] < 100]
    assert {r["component"] for r in of_few if r["whitened"] is not None} == {1, 2, 3, 4} and {r["identity_error"] < 1e-9 for r in of_few} == {True}
    assert whitening.whiten(spark.createDataFrame([], VECTORS)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, None, 0)], VECTORS)).collect() == []


def test_whitening_of_wide_entries(spark):
    """Beyond 64 bits: exact where it fits, null where it doesn't."""
    schema = "vec_id long, embedding array<double>"
    rows = [(1, [0.0, 2.0**30, 5.0]), (2, [1.5, -(2.0**30), 7.0]), (3, [2.0, 1.0, 9.0]), (4, [2.0**45, 0.0, 0.0]), (5, [1e300, 0.0, 0.0])]
    got = {r["vec_id"]: r["deviation"] for r in whitening.whiten(spark.createDataFrame(rows, schema)).collect()}
    assert got == {1: None, 2: None, 3: None, 4: None}
    small = rows[:3]
    got = {r["vec_id"]: r["deviation"] for r in whitening.whiten(spark.createDataFrame([(i, [a, b / 64, c]) for i, (a, b, c) in small], schema)).collect()}
    want = {i: d for i, _, _, d, *_ in whitened_brute([(i, [a, b / 64, c]) for i, (a, b, c) in small])}
    assert got == {i: d if d < 2**63 else None for i, d in want.items()}
