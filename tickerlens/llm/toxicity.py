"""Toxicity as an ordinal severity, by cumulative-link regression.

Severity has grades 0 to 3.  The labels say toxic or not; how severe a toxic
text is follows from how many of its words are markers, words that labelled
toxic texts use and others hardly do (see ``grades``).  The model gives
P(grade > k) = logistic(w . x - b_k) for k = 0, 1, 2 with one weight vector
for all thresholds and b_0 < b_1 < b_2; x are log(1 + rate) of words and of
word beginnings, so that inflected and compound forms count too, with rates in
a hundred words, so that a long clean text isn't toxic for a chance hit.  The
expected severity is the sum of the three probabilities.

The model is fitted to at most ``MAX_LABELLED`` labelled rows, picked by a hash
of their ids, and to the ``MAX_FEATURES`` features that tell the classes apart
best.  Features are counted in tasks; the driver gets the chosen names and each
labelled row's counts of them, never a text.  Scoring reads every word of every
text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerlens.llm.common import Memo, cut

MAX_LABELLED = 8000
MAX_FEATURES = 512
PREFIXES = (4, 5, 6)
GRADES = 4
#: Marker words from which a toxic text has the second, and the third, grade.
GRADE_MARKERS = (4, 8)
NOT_A_LETTER = re.compile(r"[\W\d_]+")
#: Texts shorter than this count as this long, where rates are taken.
LEAST_WORDS = 50
#: Tokens whose features the driver remembers while it fits.
FIT_MEMO = 50_000
STEPS = 400
RATE = 0.1
RIDGE = 1e-3
#: A text is called toxic from this probability on.  The labels hold some
#: texts without a toxic word, which pulls all probabilities down.
TOXIC_AT = 0.2


def features_of(token: str) -> list[str]:
    """A token's word, and its beginnings (marked with ``-``)."""
    word = NOT_A_LETTER.sub("", token.lower())
    return [word, *(word[:n] + "-" for n in PREFIXES if len(word) > n)] if word else []


def counted(text: str | None, names: Memo, keep: frozenset | None = None) -> Counter:
    """How often each feature (of those in ``keep``) occurs in a text."""
    found = Counter(f for token in (text or "").split() for f in names[token])
    return found if keep is None else Counter({f: n for f, n in found.items() if f in keep})


def strength(n: np.ndarray | int, words: int) -> np.ndarray | float:
    """A feature's value: n hits in a text of so many words."""
    return np.log1p(100 * n / max(words, LEAST_WORDS))


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    thresholds: tuple[float, ...] = (50.0, 51.0, 52.0)

    def probabilities(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k), a column for each k."""
        z = np.clip(np.asarray(score, float)[:, None] - np.array(self.thresholds), -50, 50)
        return 1 / (1 + np.exp(-z))


def chosen_features(texts: list[str | None], toxic: np.ndarray, names: Memo, most: int = MAX_FEATURES) -> list[str]:
    """Features in more of the toxic texts than of the others, by their
    G-statistic. Only features of toxic texts are held while texts are read."""
    inside: Counter = Counter()
    for text in (t for t, is_toxic in zip(texts, toxic, strict=True) if is_toxic):
        inside.update(counted(text, names).keys())
    inside = Counter({f: n for f, n in inside.items() if n >= 3})
    outside: Counter = Counter()
    for text in (t for t, is_toxic in zip(texts, toxic, strict=True) if not is_toxic):
        outside.update(counted(text, names).keys() & inside.keys())
    n1, n0 = int(toxic.sum()), int((~toxic).sum())
    scored = []
    for name, a in inside.items():
        b = outside[name]
        rate1, rate0, rate = a / n1, b / n0, (a + b) / (n1 + n0)
        if rate1 > 2 * rate0:
            g = a * np.log(rate1 / rate) + (b * np.log(rate0 / rate) if b else 0.0)
            scored.append((-g, name))
    return [name for _, name in sorted(scored)[:most]]


def grades(rows: list[Counter], toxic: np.ndarray, names: list[str]) -> np.ndarray:
    """0 for texts that are not toxic; 1, 2 or 3 by their number of marker
    words (each toxic text has at least grade 1)."""
    markers = [n for n in names if not n.endswith("-")]
    hits = np.array([sum(row[m] for m in markers) for row in rows])
    return np.where(toxic, 1 + sum((hits >= g).astype(int) for g in GRADE_MARKERS), 0)


def fit(texts: list[str | None], toxic: list[bool], max_features: int = MAX_FEATURES, steps: int = STEPS) -> Model:
    """A model of the labelled texts; without both classes, one that finds nothing."""
    is_toxic = np.array(toxic, bool)
    if not is_toxic.any() or is_toxic.all():
        return Model()
    names_of = Memo(features_of, FIT_MEMO)
    names = chosen_features(texts, is_toxic, names_of, max_features)
    rows = [counted(t, names_of, frozenset(names)) for t in texts]
    return fit_counts(names, rows, [len((t or "").split()) for t in texts], is_toxic, steps)


def fit_counts(names: list[str], rows: list[Counter], lengths: list[int], is_toxic: np.ndarray, steps: int = STEPS) -> Model:
    """``fit`` to each text's counts of the chosen features and its words."""
    y = grades(rows, is_toxic, names)
    at = {n: i for i, n in enumerate(names)}
    # Rows without any feature differ in nothing but their grade: one row each, with a weight.
    distinct = Counter((tuple(sorted((at[f], strength(row[f], n)) for f in row.keys() & at.keys())), int(g)) for row, n, g in zip(rows, lengths, y, strict=True))
    x = np.zeros((len(distinct), len(names)))
    for i, (found, _) in enumerate(distinct):
        for f, value in found:
            x[i, f] = value
    above = (np.array([[g] for _, g in distinct]) > np.arange(GRADES - 1)).astype(float)
    share = np.array(list(distinct.values()))[:, None] / len(rows)
    # Parameters: weights, the first threshold, and logarithms of the gaps to the next.
    w = np.concatenate([np.zeros(len(names)), [1.0, 0.0, 0.0]])
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        gaps = np.exp(w[-2:])
        b = w[len(names)] + np.array([0, gaps[0], gaps.sum()])
        p = 1 / (1 + np.exp(-np.clip(x @ w[: len(names)], -50, 50)[:, None] + b))
        wrong = (p - above) * share  # each threshold is a logistic regression with shared weights
        down = -wrong.sum(axis=0)
        grad = np.concatenate([x.T @ wrong.sum(axis=1) + RIDGE * w[: len(names)], [down.sum(), down[1:].sum() * gaps[0], down[2] * gaps[1]]])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    gaps = np.exp(w[-2:])
    b = w[len(names)] + np.array([0, gaps[0], gaps.sum()])
    return Model({n: float(w[i]) for i, n in enumerate(names)}, tuple(map(float, b)))


def telling_features(labelled: DataFrame, n_toxic: int, n_clean: int, most: int = MAX_FEATURES) -> list[str]:
    """``chosen_features`` of ``(text, toxic)`` rows, counted by Spark: the
    driver gets at most ``most`` names."""

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Memo(features_of, FIT_MEMO)
        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                found = list(counted(text.as_py(), names))
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array([toxic] * len(found), pa.bool_())], ["name", "toxic"])

    seen = labelled.select("text", "toxic").mapInArrow(distinct, "name string, toxic boolean")
    a, b = F.col("a"), F.col("b")
    rate1, rate0, rate = a / n_toxic, b / n_clean, (a + b) / (n_toxic + n_clean)
    counts = seen.groupBy("name").agg(F.count_if("toxic").alias("a"), F.count_if(~F.col("toxic")).alias("b"))
    telling = counts.where((a >= 3) & (rate1 > 2 * rate0))
    g = a * F.log(rate1 / rate) + F.when(b > 0, b * F.log(rate0 / rate)).otherwise(0.0)
    return [r["name"] for r in telling.orderBy(F.desc(g), "name").limit(most).collect()]


def feature_counts(labelled: DataFrame, names: list[str]) -> DataFrame:
    """``(doc_id, toxic, words, found)``: a text's words, and its counts of
    ``names`` by their place."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = {n: i for i, n in enumerate(names)}
        known, keep = Memo(features_of, FIT_MEMO), frozenset(names)
        for batch in batches:
            texts = [t.as_py() or "" for t in batch.column(2)]
            found = [[(at[f], n) for f, n in counted(t, known, keep).items()] for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(t.split()) for t in texts], pa.int64()), pa.array(found, pa.map_(pa.int32(), pa.int64()))],
                ["doc_id", "toxic", "words", "found"])

    return labelled.select("doc_id", "toxic", "text").mapInArrow(count, "doc_id long, toxic boolean, words long, found map<int,bigint>")


def fit_to_labels(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Fitted to at most ``max_labelled`` labelled rows.  Null ids and labels
    are left out; a document with several labels is toxic if one says so.

    The driver gets at most ``MAX_FEATURES`` counts for each of these rows,
    however long their texts are."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    known = known.groupBy(F.col(id_col).cast("long").alias("doc_id")).agg((F.max(F.col(label_col).cast("int")) > 0).alias("toxic"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # The sample's ids are bounded by max_labelled, so they can go to every task.
    labelled = texts.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    labelled = cut(labelled)  # read twice below
    n_toxic, n_clean = labelled.agg(F.count_if("toxic"), F.count_if(~F.col("toxic"))).first()
    if not n_toxic or not n_clean:
        return Model()
    names = telling_features(labelled, n_toxic, n_clean)
    rows = feature_counts(labelled, names).collect()
    rows.sort(key=lambda r: r["doc_id"])
    found = [Counter({names[i]: n for i, n in r["found"].items()}) for r in rows]
    return fit_counts(names, found, [r["words"] for r in rows], np.array([r["toxic"] for r in rows], bool))


def severities(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, severity, grade, p_toxic, toxic)``, a row for each row of ``docs``.

    ``severity`` is the expected grade, ``grade`` the number of thresholds
    that the text more likely passes than not, ``toxic`` says whether
    it passes the first with ``TOXIC_AT`` or more.  Null and empty texts have no features, and so the
    severity of the thresholds alone.  Rows that repeat, share an id or have a
    null one are scored each for itself.  Texts are scored whole.  Other
    columns are not read; no rows give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = list(model.weights)
        weights = np.array([model.weights[n] for n in order])
        at = {n: i for i, n in enumerate(order)}
        known = Memo(lambda token: tuple(at[f] for f in features_of(token) if f in at))
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            for i, text in enumerate(batch.column(1).to_pylist()):
                tokens = (text or "").split()
                hits = [f for fs in map(known.__getitem__, tokens) if fs for f in fs]
                if hits:
                    which, n = np.unique(hits, return_counts=True)
                    scores[i] = strength(n, len(tokens)) @ weights[which]
            p = model.probabilities(scores)
            columns = [pa.array(p.sum(axis=1)), pa.array((p >= 0.5).sum(axis=1).astype(np.int32)), pa.array(p[:, 0]), pa.array(p[:, 0] >= TOXIC_AT)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "severity", "grade", "p_toxic", "toxic"])

    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return given.mapInArrow(run, "doc_id long, severity double, grade int, p_toxic double, toxic boolean")


def score_corpus(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    return severities(docs, fit_to_labels(docs, labels, max_labelled))
