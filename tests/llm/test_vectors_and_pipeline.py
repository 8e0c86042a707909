"""The metric range join, connected components and the pipeline."""

from __future__ import annotations

import glob
import math
import random
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from fixtures import SCHEMA, awkward, corpus, rows_of, with_clashes
from test_dedup import key_of, lines_brute, near_brute
from test_text_operators import check_packing

from tickerlens.llm import common, minmax_dedup, packing, quality_rules, vector_range_join

VECTORS = "vec_id long, embedding array<float>, label int"
NULL = -(2**63)


def vectors(seed, n=400, dims=16):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, dims))
    rows = []
    for i in range(n):
        kind = rng.random()
        v = rng.normal(size=dims) if kind < 0.3 else centres[rng.integers(5)] + rng.normal(size=dims) * rng.choice([0.05, 0.2, 0.4])
        if rows and kind > 0.9:
            v = np.array(rows[rng.integers(len(rows))][1])
        rows.append((i, [float(np.float32(x)) for x in v], int(rng.integers(2))))
    return rows


ODD_VECTORS = [
    (None, [1.0, 2.0], 1), (1000, None, 1), (1001, [], 1), (1002, [0.0, 0.0], 1), (1003, [1.0, None], 1), (1004, [float("nan"), 1.0], 1),
    (1005, [float("inf"), 1.0], 1), (1006, [1.0, 2.0], None), (1007, [1.0, 2.0], 1), (1007, [1.0, 2.0], 1), (1008, [2.0, 4.0], 1), (1009, [1.0, 2.0, 0.0], 1), (1010, [-0.0, 3.0], 1), (1011, [0.0, 3.0], 1),
]


def vectors_brute(rows, cosine=0.93):
    """Equal rows are one vector; of those that share an id and differ, ``n_links`` and the component alone are told."""
    key = lambda r: (NULL if r[0] is None else r[0], repr(r[1:]))
    own = {}
    for r in rows:
        _, v, label = r
        good = v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
        own[key(r)] = (label, np.array(v, float)) if good else None
    ids, links, label = sorted(own), Counter(), {i: i for i in own}
    pairs = []
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = own[a], own[b]
            if x and y and x[0] == y[0] and len(x[1]) == len(y[1]) and x[1] @ y[1] / np.sqrt((x[1] @ x[1]) * (y[1] @ y[1])) >= cosine:
                pairs.append((a, b))
                links.update((a, b))
    for _ in ids:
        before = dict(label)
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
        if before == label:
            break
    out = lambda d: None if d[0] == NULL else d[0]
    return sorted(((r[0], links[key(r)], out(label[key(r)]), label[key(r)] == key(r)) for r in rows), key=repr)


def test_vectors_that_share_an_id(spark):
    rows = [(5, [1.0, 0.0], 1), (5, [0.0, 1.0], 1), (None, [1.0, 0.1], 1), (None, [-1.0, 0.0], 1), (9, [0.1, 1.0], 1), (9, [0.1, 1.0], 1), (5, None, 1)]
    assert rows_of(vector_range_join.link_vectors(spark.createDataFrame(rows, VECTORS))) == vectors_brute(rows)


@pytest.mark.parametrize("cell, block, row_cost", [(4096, 4096, 500), (20, 4096, 0), (50, 16, 0)])
def test_linked_vectors(spark, cell, block, row_cost, monkeypatch):
    monkeypatch.setattr(vector_range_join, "BLOCK", block)
    monkeypatch.setattr(vector_range_join, "ROW_COST", row_cost)
    monkeypatch.setattr(vector_range_join.choose_pivots, "__defaults__", (cell, 4096))
    rows = vectors(1) + ODD_VECTORS
    out = vector_range_join.link_vectors(with_clashes(spark.createDataFrame(rows, VECTORS)))
    assert rows_of(out) == vectors_brute(rows)


def test_replication_is_enough():
    """Each pair within the radius meets in the home cell of both."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 8))
    x /= np.linalg.norm(x, axis=1)[:, None]
    radius = 0.5
    home, goes = vector_range_join.cells_of(x, x[:12], radius)
    near = np.linalg.norm(x[:, None] - x[None], axis=2) <= radius
    for i, j in zip(*np.nonzero(near), strict=True):
        assert goes[j, home[i]]
    assert goes.mean() < 0.9


def unit_rows(rng, n, dims):
    x = rng.normal(size=(n, dims))
    return x / np.linalg.norm(x, axis=1)[:, None]


def test_pivots_by_the_least_work(spark):
    """Many pivots where vectors cluster, one where each would go to every cell."""
    rng = np.random.default_rng(4)
    noise, centres = unit_rows(rng, 2000, 64), unit_rows(rng, 20, 64)
    near = centres[rng.integers(20, size=2000)] + 0.005 * rng.normal(size=(2000, 64))
    rows = [(1, 64, i, 1, v.tobytes()) for i, v in enumerate(noise)]
    rows += [(2, 64, 10_000 + i, 1, (v / np.linalg.norm(v)).tobytes()) for i, v in enumerate(near)]
    frame = spark.createDataFrame(rows, "label long, dims int, rep long, copies long, vec binary")
    chosen = vector_range_join.choose_pivots(frame, math.sqrt(2 - 2 * 0.93), cell=20)
    assert len(chosen[1, 64]) == 1 and len(chosen[2, 64]) > 10


def test_vectors_are_sent_in_slices():
    """What goes to every cell leaves a task in bounded batches, all of it."""
    x = unit_rows(np.random.default_rng(5), 700, 8)
    batch = pa.RecordBatch.from_pydict({"label": [1] * 700, "dims": [8] * 700, "rep": list(range(700)), "copies": [1] * 700, "vec": [v.tobytes() for v in x]})
    out = list(vector_range_join._dealt({(1, 8): x[:40]}, 2.0)([batch]))
    assert max(len(b) for b in out) <= vector_range_join.SENT
    seen = [pair for b in out for pair in zip(b.column("rep").to_pylist(), b.column("cell").to_pylist(), strict=True)]
    assert len(seen) == len(set(seen)) == 700 * 40 and sum(sum(b.column("home").to_pylist()) for b in out) == 700


def test_no_vectors(spark):
    assert vector_range_join.link_vectors(spark.createDataFrame([], VECTORS)).collect() == []


@pytest.mark.parametrize("hot_share", [512, 4, 1])
def test_components(spark, hot_share, monkeypatch):
    """All nodes hot, the centre of a star alone, and none."""
    monkeypatch.setattr(common, "HOT_SHARE", hot_share)
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 40)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)] + [(5, 5)]
    edges += [(500, 400 + i) for i in range(80)]
    label = {x: x for e in edges if e[0] != e[1] for x in e}
    for _ in label:
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    assert sorted(map(tuple, common.components(spark.createDataFrame(edges, "src long, dst long")).collect())) == sorted(label.items())


# --------------------------------------------------------------- pipeline


def test_stages_against_brute_force(spark, tmp_path):
    import corpus_pipeline
    from tokenizers import Tokenizer

    rows = corpus(21, 150) + [(1000 + i, t, a, b, c) for i, (_, t, a, b, c) in enumerate(awkward())]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, "")
        if i < 4:
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        kept.append([tuple(r) for r in docs.collect()])
    good = {r["doc_id"] for r in quality_rules.judge(spark.createDataFrame(rows, SCHEMA)).where("kept").collect()}
    assert sorted(r[0] for r in kept[0]) == sorted(r[0] for r in rows if r[0] in good)
    assert sorted(((r[0], r[1]) for r in kept[1]), key=repr) == sorted(((d, t) for d, _, _, t in lines_brute(kept[0], long_docs=8)), key=repr)
    once = {key_of(r): r for r in kept[1]}.values()
    assert sorted(r[0] for r in kept[2]) == sorted(d for d, _, _, first in near_brute(once, 5, (4, 5)) if first)
    copies = Counter(r[0] for r in kept[3])
    assert set(copies) == {r[0] for r in kept[2]} and max(copies.values()) <= corpus_pipeline.MAX_REPEATS + 1
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    check_packing(kept[3], docs.collect(), lambda t: tokenizer.encode(t, add_special_tokens=False).ids, 2048)


def test_run_over_the_tables(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 100 and "sequence_id" in out.columns


def test_every_query_is_registered():
    import __spark_entry__

    names = list(__spark_entry__.queries())
    assert sorted({int(n[2 : n.index("_")]) for n in names if n.startswith("op")}) == list(range(1, 14)) and "pipeline" in names


def test_defaults_of_near_duplicates():
    assert minmax_dedup.near_duplicates.__defaults__[:2] == (5, (4, 5))


def test_no_shuffle_outlives_a_cut(spark):
    """What is cut leaves no shuffle data behind (it used to until the driver's next garbage collection)."""

    def shuffles():
        dirs = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString()
        return {x for d in dirs for x in glob.glob(f"{d}/**/shuffle_*.data", recursive=True)}

    before = shuffles()
    made = common.cut(spark.range(1000).groupBy((common.F.col("id") % 10).alias("k")).agg(common.F.count("*").alias("n")))
    waited = time.time() + 10
    while shuffles() - before and time.time() < waited:
        time.sleep(0.2)
    assert not shuffles() - before
    assert {tuple(r) for r in made.collect()} == {(k, 100) for k in range(10)}
