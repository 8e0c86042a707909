"""Word-polarity lexicon for post sentiment.

A ``Lexicon`` holds word lists given in code and is compiled into the scan's
expression. A lexicon that is a table, of any size, is joined instead: see
``tickerlens.operators.mentions.mention_series_with_lexicon``.

The default lists are fixed values: they must equal the surveyed system's word
lists for results to match. They are kept as plain text, in their original
order (including the two repeated entries, which a set ignores).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---- fixed values: default positive and negative words -------------------
POSITIVE_WORDS = (
    "upgrade", "upgraded", "long", "buy", "buying", "growth", "good", "gained",
    "well", "great", "nice", "top", "support", "update", "strong", "bullish",
    "bull", "highs", "win", "positive", "profits", "bonus", "potential",
    "success", "winner", "winning", "good",
)
NEGATIVE_WORDS = (
    "downgraded", "bears", "bear", "bearish", "volatile", "short", "sell",
    "selling", "forget", "down", "resistance", "sold", "sellers", "negative",
    "selling", "blowout", "losses", "war", "lost", "loser",
)
# ---------------------------------------------------------------------------

@dataclass(frozen=True)
class Lexicon:
    positive: tuple[str, ...]
    negative: tuple[str, ...]

    def __post_init__(self):
        object.__setattr__(self, "positive", tuple(dict.fromkeys(self.positive)))
        object.__setattr__(self, "negative", tuple(dict.fromkeys(self.negative)))

    def as_dataframe(self, spark) -> DataFrame:
        """``(word, polarity)`` table form of the lexicon (positive wins on overlap)."""
        rows = [(w, 1) for w in self.positive]
        rows += [(w, -1) for w in self.negative if w not in set(self.positive)]
        return spark.createDataFrame(rows, "word string, polarity int")

    def polarity(self, word):
        """+1 / -1 / 0 for a token Column (positive checked first)."""
        return (F.when(word.isin(*self.positive), F.lit(1))
                .when(word.isin(*self.negative), F.lit(-1))
                .otherwise(F.lit(0)))


DEFAULT_LEXICON = Lexicon(POSITIVE_WORDS, NEGATIVE_WORDS)
