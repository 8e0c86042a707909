"""Small tables for the corpus operators: ordinary texts, and awkward rows."""

from __future__ import annotations

import random
import string

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names the operators use inside.
CLASHING = ["row", "_a", "_id", "_row_key", "_kept", "_changed", "_gone", "kept", "text_", "a.b", "key", "mini", "n", "leaf", "masked", "rep", "component", "_text", "_words", "size", "block", "copy", "rank", "tokens", "digest", "x0", "bin", "id"]


def vocabulary(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choices(string.ascii_lowercase, k=rng.randint(2, 9))) for _ in range(n)]


def prose(rng: random.Random, words: list[str], n: int) -> str:
    out, line = [], []
    for _ in range(n):
        line.append(rng.choice(words))
        if rng.random() < 0.08:
            out.append(" ".join(line))
            line = []
    return "\n".join([*out, " ".join(line)])


def edited(rng: random.Random, text: str, share: float, words: list[str]) -> str:
    return " ".join(rng.choice(words) if rng.random() < share else w for w in text.split(" "))


def corpus(seed: int = 1, n: int = 60) -> list[tuple]:
    """Texts with copies, near copies, shared passages and repeats inside."""
    rng = random.Random(seed)
    words = vocabulary(rng, 400)
    passage = prose(rng, words, 60).replace("\n", " ")
    rows, texts = [], []
    for i in range(n):
        kind = rng.random()
        if texts and kind < 0.15:
            text = rng.choice(texts)
        elif texts and kind < 0.4:
            text = edited(rng, rng.choice(texts), rng.choice([0.005, 0.02, 0.05]), words)
        elif kind < 0.55:
            text = prose(rng, words, rng.randint(5, 80)) + " " + passage + "\n" + prose(rng, words, 40)
        elif kind < 0.65:
            part = prose(rng, words, 30)
            text = part + "\t" + part + "\x0b" + prose(rng, words, 10)
        else:
            text = prose(rng, words, rng.randint(1, 200))
        texts.append(text)
        rows.append((i, text, rng.choice(["en", "de"]), f"src{rng.randint(0, 2)}", len(text)))
    return rows


def awkward(seed: int = 2) -> list[tuple]:
    """Nulls in any column, empty, blank and very long texts, repeated rows and ids."""
    rng = random.Random(seed)
    words = vocabulary(rng, 5000)
    long = prose(rng, words, 30_000)
    same = prose(rng, words, 50)
    return [
        (None, same, None, None, None),
        (1, None, "en", "a", 0),
        (2, "", "en", None, 0),
        (3, " \n\t ", None, "a", 4),
        (4, long, "en", "a", len(long)),
        (5, long, "en", "a", len(long)),
        (6, same, "en", "b", len(same)),
        (6, same, "en", "b", len(same)),
        (7, same + " x", "en", "b", len(same) + 2),
        (7, same + " y", "en", "b", len(same) + 2),
        (8, "één ünïcode   \U0001f600 words", "fr", "b", 30),
    ]


def with_clashes(df):
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit("clash") for c in CLASHING if c not in df.columns})


def rows_of(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
