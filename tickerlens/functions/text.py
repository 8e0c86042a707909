"""Cashtag extraction, tokenisation and post scoring as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickerlens.functions.lexicon import DEFAULT_LEXICON, Lexicon

# ---- fixed values: patterns ----------------------------------------------
CASHTAG_PATTERN = r"\$[A-Z]+"     # case-sensitive, prefix matches count
WORD_SPLIT_PATTERN = r"\W|\s|\d"  # ASCII word chars; '_' stays inside a token
# ---------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cashtags(text) -> Column:
    """Every ``$TICKER`` occurrence in raw-case text, in order (STR-1)."""
    return F.regexp_extract_all(_col(text), F.lit(CASHTAG_PATTERN), 0)


def strip_cashtag(tag) -> Column:
    """``$AAPL`` -> ``AAPL`` (PRJ-7)."""
    return F.substring(_col(tag), 2, 1 << 30)


def tickers(text) -> Column:
    """Ticker occurrences without the sign."""
    return F.transform(cashtags(text), lambda t: F.substring(t, 2, 1 << 30))


def tokens(text) -> Column:
    """``lower(trim(text))`` split on non-word, space or digit (STR-2, STR-3)."""
    return F.split(F.lower(F.trim(_col(text))), WORD_SPLIT_PATTERN)


def post_score(text, lexicon: Lexicon = DEFAULT_LEXICON) -> Column:
    """Sum of token polarities of one post (LEX-1, LEX-2), no explode."""
    return F.aggregate(tokens(text), F.lit(0), lambda acc, w: acc + lexicon.polarity(w))


def strip_quotes(s) -> Column:
    """Remove single and double quotes, as the dashboard does for authors (STR-6)."""
    return F.regexp_replace(_col(s), "['\"]+", "")


def colour(sentiment) -> Column:
    """green / red / blue class of a sentiment value (MTH-3)."""
    s = _col(sentiment)
    return F.when(s > 0, F.lit("green")).when(s < 0, F.lit("red")).otherwise(F.lit("blue"))


def sentiment_sign(sentiment) -> Column:
    """-1 / 0 / 1 (MTH-2)."""
    return F.signum(_col(sentiment)).cast("int")


def author_importance(followers, friends) -> Column:
    """followers / friends when friends > 10, else 1 (MTH-1)."""
    fo, fr = _col(followers), _col(friends)
    return F.when(fr > 10, fo.cast("double") / fr.cast("double")).otherwise(F.lit(1.0))
