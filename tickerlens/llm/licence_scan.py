"""Licence scans by a positional index of rare words.

Templates are short passages of licence notices.  An index holds, for each of
their words, the templates and places where it stands.  How rare a word is
follows from the number of documents of the corpus that hold it.  For each
template that shares words with a file, the file's rarest ones (the highest
inverse document frequency) are looked up, and their postings are intersected
by relative position: a place in the file less the place in the template is
where the template would begin, and beginnings that at least half of the looked
up words agree on are candidates.  A candidate holds if enough of the
template's words stand at their places and its mandatory key phrase stands
whole at its own.

The index is as large as the templates, whatever the corpus; a file's work is
linear in its words.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerlens.llm.common import binary

#: The phrases that count by themselves, with their labels.
PHRASES = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)
#: Label, passage of the licence's notice, mandatory key phrase; words as ``words_of`` makes them.
TEMPLATES = (
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "permission is hereby granted free of charge"),
    ("apache", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at", "not use this file except in compliance"),
    ("gpl", "licensed under the gnu general public license version 3", "gnu general public license"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gnu general public license"),
    ("lgpl", "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation", "gnu lesser general public license"),
    ("agpl", "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation", "gnu affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution and use in source and binary forms"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "with or without fee"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", "creative commons attribution 4 0"),
    ("cc-by", "licensed under cc by 4 0", "cc by 4 0"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license", "creative commons attribution noncommercial"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
)
#: Rarest words of a template that are looked up in a file.
ANCHORS = 8
#: Of a template's words, how many of ten have to stand at their places.
SHARE = 8

#: A-Z to a-z; what is neither a letter, a digit nor beyond ASCII to a blank.
_NORMAL = bytes(ord(chr(b).lower()) if chr(b).isalnum() or b >= 128 else 32 for b in range(128)) + bytes(range(128, 256))


def words_of(raw: bytes | None) -> list[bytes]:
    return (raw or b"").translate(_NORMAL).split()


class Index:
    """Postings of the templates' words."""

    def __init__(self, templates: tuple[tuple[str, str, str], ...] = TEMPLATES):
        self.labels = [label for label, _, _ in templates]
        self.words = [words_of(passage.encode()) for _, passage, _ in templates]
        self.keys = [words_of(key.encode()) for _, _, key in templates]
        self.key_at = [_places(w, k)[0] for w, k in zip(self.words, self.keys, strict=True)]
        self.postings: dict[bytes, dict[int, list[int]]] = defaultdict(dict)
        for t, words in enumerate(self.words):
            for at, word in enumerate(words):
                self.postings[word].setdefault(t, []).append(at)


def _places(words: list[bytes], phrase: list[bytes], at: list[int] | None = None) -> list[int]:
    """Where ``phrase`` stands in ``words``; ``at``: places of its first word."""
    starts = at if at is not None else [i for i, w in enumerate(words) if w == phrase[0]]
    return [i for i in starts if words[i : i + len(phrase)] == phrase]


def aligned(words: list[bytes], index: Index, rarity: dict[bytes, int], anchors: int = ANCHORS, share: int = SHARE) -> list[tuple[int, int, int]]:
    """``(template, beginning, words at their places)`` of what holds;
    ``rarity`` orders the index's words, the rarest first."""
    at: dict[bytes, list[int]] = {}
    for word in set(words) & index.postings.keys():
        at[word] = []
    if not at:
        return []
    for i, word in enumerate(words):
        if word in at:
            at[word].append(i)
    looked_up: Counter[int] = Counter()
    votes: dict[int, Counter[int]] = defaultdict(Counter)
    wanted = {t for t, key in enumerate(index.keys) if all(w in at for w in key)}  # the others can't hold
    for word in sorted(at, key=rarity.__getitem__):
        for t, places in index.postings[word].items():
            if t in wanted and looked_up[t] < anchors:
                looked_up[t] += 1
                votes[t].update({p - q for p in at[word] for q in places})  # a word votes once for a beginning
    found = []
    for t, begins in votes.items():
        template, key = index.words[t], index.keys[t]
        for begin, n in begins.items():
            if 2 * n < looked_up[t]:
                continue
            here = sum(0 <= begin + q < len(words) and words[begin + q] == w for q, w in enumerate(template))
            first = begin + index.key_at[t]
            if 10 * here >= share * len(template) and first >= 0 and words[first : first + len(key)] == key:
                found.append((t, begin, here))
    return found


def _document_counts(texts: DataFrame, index: Index) -> dict[bytes, int]:
    """In how many documents each word of the index stands: sums a task first,
    then over all; a row for each word of the templates at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()
        known = index.postings.keys()
        for batch in batches:
            for raw in binary(batch.column(1)):
                total.update(known & set(words_of(raw.as_py())))
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())], ["word", "docs"])

    counted = texts.mapInArrow(run, "word binary, docs long").groupBy("word").agg(F.sum("docs").alias("docs"))
    return {bytes(r["word"]): r["docs"] for r in counted.collect()}


def scan_licences(docs: DataFrame, anchors: int = ANCHORS, share: int = SHARE, templates: tuple[tuple[str, str, str], ...] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score, passages)``, a row for each row of ``docs``.

    Words are runs of letters, digits and characters beyond ASCII, A-Z lower
    case.  ``n_base`` counts the places of ``PHRASES``, ``first_word`` and
    ``last_word`` are the least and greatest of them (null if there are none),
    ``base_labels`` their labels; ``labels`` has those of the templates found
    too, both distinct, sorted and joined by commas.  ``passages`` lists the
    templates found, as ``(label, first_word, n_words, n_matched)`` in the order
    of their places.  ``score`` is the greatest share of a found passage's words
    that stand at their places, 1 where a phrase stands, 0 where nothing does.

    Null and empty texts have no words, and empty labels.  Rows that repeat,
    share an id or have a null one keep a row each, and count each for a word's
    rarity; equally rare words go by their bytes.  Texts are taken whole,
    whatever their length.  Other columns are not read, so their names can't
    clash.  An empty table gives no rows.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    index = Index(templates)
    counts = _document_counts(texts, index)
    rarity = {w: i for i, w in enumerate(sorted(index.postings, key=lambda w: (counts.get(w, 0), w)))}
    phrases = [(words_of(p.encode()), label) for p, label in PHRASES]

    def scanned(raw: bytes | None) -> tuple:
        words = words_of(raw)
        base, labels = [], set()
        if b"license" in words:
            ends = [i for i, w in enumerate(words) if w == b"license"]
            for phrase, label in phrases:
                places = _places(words, phrase, [i - len(phrase) + 1 for i in ends if i + 1 >= len(phrase)])
                base += places
                labels |= {label} if places else set()
        found = sorted((begin, t, here) for t, begin, here in aligned(words, index, rarity, anchors, share))
        every = labels | {index.labels[t] for _, t, _ in found}
        score = 1.0 if base else max((here / len(index.words[t]) for _, t, here in found), default=0.0)
        passages = [{"label": index.labels[t], "first_word": begin, "n_words": len(index.words[t]), "n_matched": here} for begin, t, here in found]
        return len(words), len(base), min(base, default=None), max(base, default=None), ",".join(sorted(labels)), ",".join(sorted(every)), score, passages

    passage = pa.struct([("label", pa.string()), *((n, pa.int64()) for n in ("first_word", "n_words", "n_matched"))])
    types = {**dict.fromkeys(("n_words", "n_base", "first_word", "last_word"), pa.int64()), "base_labels": pa.string(), "labels": pa.string(), "score": pa.float64(), "passages": pa.list_(passage)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [scanned(raw.as_py()) for raw in binary(batch.column(1))]
            columns = list(zip(*rows, strict=True)) or [()] * len(types)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types.values(), strict=True))], ["doc_id", *types])

    return texts.mapInArrow(
        run,
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double,"
        " passages array<struct<label string, first_word long, n_words long, n_matched long>>",
    )
