"""DuckDB oracle SQL building blocks.

Each registered query has an independent SQL statement over the driver's
tables. The fixture rules of ``tickerlens.sources.fixtures`` are restated here
in SQL; the fixed word lists are the one thing both sides import.
"""

from __future__ import annotations

from tickerlens.functions.lexicon import NEGATIVE_WORDS, POSITIVE_WORDS


def _in_list(words) -> str:
    return ", ".join("'" + w + "'" for w in dict.fromkeys(words))


POS = _in_list(POSITIVE_WORDS)
NEG = _in_list(NEGATIVE_WORDS)

TK = ("chr(CAST(65 + (user_id // 676) % 26 AS INTEGER)) || chr(CAST(65 + (user_id // 26) % 26 AS INTEGER))"
      " || chr(CAST(65 + user_id % 26 AS INTEGER))")

# ev: events + ticker + k.  posts: fixture posts with the post time (seconds).
BASE = f"""
ev AS (
  SELECT event_id, ts, user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         {TK} AS tk
  FROM events
),
posts AS (
  SELECT event_id AS id, date_trunc('second', ts) AS pts, tk,
         CAST(floor(value * 10) AS INTEGER) AS followers, k AS friends,
         'u' || CAST(user_id AS VARCHAR) AS uname,
         '$' || tk || ' ' ||
         CASE event_type WHEN 'purchase' THEN 'Buying' WHEN 'error' THEN 'sell short'
              WHEN 'view' THEN 'good GOOD' WHEN 'signup' THEN 'chart'
              WHEN 'click' THEN 'down_trend' ELSE '' END ||
         CASE WHEN event_id % 7 = 0 THEN ' $' || tk || 'x $ZZZ' ELSE '' END AS text
  FROM ev
),
scored AS (
  SELECT *, CAST(list_sum(list_transform(string_split_regex(lower(trim(text)), '\\W|\\s|\\d'),
            lambda w: CASE WHEN w IN ({POS}) THEN 1 WHEN w IN ({NEG}) THEN -1 ELSE 0 END)) AS BIGINT) AS score
  FROM posts
),
occ AS (
  SELECT s.*, substr(t.tag, 2) AS ticker
  FROM scored s, unnest(regexp_extract_all(s.text, '\\$[A-Z]+')) AS t(tag)
),
trades AS (
  SELECT tk AS ticker, ts AS time, value AS price, CAST(k AS DOUBLE) AS quantity, event_id AS seq,
         timezone('America/Los_Angeles', timezone('Europe/Oslo', ts)) AS lt
  FROM ev
)"""


def with_base(body: str) -> str:
    return "WITH " + BASE.strip() + ",\n" + body.strip()


def instant(t: str, zone: str = "Europe/Oslo") -> str:
    """The instant of a wall-clock time; of the two that a repeated autumn hour
    has, the first, as the Spark side takes it."""
    late = f"timezone('{zone}', {t})"
    return f"CASE WHEN timezone('{zone}', {late} - INTERVAL 1 HOUR) = {t} THEN {late} - INTERVAL 1 HOUR ELSE {late} END"


def with_spread_base(body: str) -> str:
    """``with_base`` over events shifted by 0..730 days by id."""
    spread = "FROM (SELECT * REPLACE (ts + to_days(CAST(event_id % 731 AS INTEGER)) AS ts) FROM events)"
    base = BASE.strip().replace("FROM events", spread).replace("timezone('Europe/Oslo', ts)", instant("ts"))
    return "WITH " + base + ",\n" + body.strip()


_PART_EXPR = {
    "year": "CAST(year({t}) AS INTEGER) AS year",
    "isoyear": "CAST(isoyear({t}) AS INTEGER) AS year",
    "week": "CAST(week({t}) AS INTEGER) AS week",
    "month": "CAST(month({t}) AS INTEGER) AS month",
    "day": "CAST(day({t}) AS INTEGER) AS day",
    "hour": "CAST(hour({t}) AS INTEGER) AS hour",
    "minute": "CAST(minute({t}) AS INTEGER) AS minute",
    "second": "CAST(floor(second({t})) AS INTEGER) AS second",
}

GRAIN_SQL_PARTS = {
    "YEAR": ("year",),
    "MONTH": ("year", "month"),
    "WEEK": ("isoyear", "week"),
    "DAY": ("year", "month", "day"),
    "HR": ("year", "month", "day", "hour"),
    "MIN": ("year", "month", "day", "hour", "minute"),
    "SEC": ("year", "month", "day", "hour", "minute", "second"),
}


def part_select(grain: str, t: str) -> str:
    return ", ".join(_PART_EXPR[p].format(t=t) for p in GRAIN_SQL_PARTS[grain])


def part_names(grain: str) -> str:
    return ", ".join("year" if p == "isoyear" else p for p in GRAIN_SQL_PARTS[grain])
