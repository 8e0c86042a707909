"""Fill-in-middle transformation over an indexable skip list.

A text is cut into units (a word with the blanks before it; blanks at the end
are one more).  The boundaries between units are the nodes of a skip list:
lane 0 holds them all, and each express lane above about one in four of the
lane below it.  A link of a lane carries two widths, the units and the code
points that it passes.  Descending from the top lane by accumulated unit widths
reaches the boundary after any number of units exactly, and the code point
widths on the way add up to the place where the text has to be cut.

Ranks and forms come from a hash of the document's id, so a task that is run
again, or a row that moves to another task, gives the same again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerlens.llm.common import U64, mix

SEED = 42
#: Of 100 documents, those that are transformed, and of those the ones with the suffix first.
FIM_PERCENT, SPM_PERCENT = 50, 80
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKER = "<[PSM]>"
#: Characters of output that a batch holds before it is handed on.
HELD = 1 << 24
ROW = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


@lru_cache(maxsize=1)
def _levels(size: int) -> np.ndarray:
    """The top lane of each node: pairs of zero bits that its hash ends with."""
    h = mix(np.arange(1, size + 1, dtype=U64))
    low = h & (~h + U64(1))
    return np.log2(np.maximum(low, U64(1)).astype(np.float64)).astype(np.int8) // 2


class SkipList:
    """Boundaries of a text's units, found by their rank."""

    def __init__(self, points: np.ndarray):
        """``points[i]``: code points before the end of unit ``i``."""
        self.n = len(points)
        at = np.r_[0, points]
        level = _levels(1 << max(16, self.n.bit_length()))[: self.n]
        nodes = np.arange(self.n + 1)
        #: By lane, the bottom one first: unit widths, code point widths, and each node's place one lane below.
        self.lanes: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        down = nodes
        for k in range(64):
            self.lanes.append((np.diff(nodes), np.diff(at[nodes]), down))
            upper = np.r_[0, 1 + np.flatnonzero(level > k)] if k < level.max(initial=0) else nodes[:1]
            if len(upper) == 1:
                break
            nodes, down = upper, np.searchsorted(nodes, upper)

    def place(self, rank: int) -> int:
        """Code points in the first ``rank`` units."""
        units = chars = node = 0
        for widths, points, down in reversed(self.lanes):
            while node < len(widths) and units + widths[node] <= rank:
                units += int(widths[node])
                chars += int(points[node])
                node += 1
            node = int(down[node])
        return chars


def unit_ends(text: str) -> np.ndarray:
    """Code points before the end of each unit of ``text``."""
    raw = np.frombuffer(text.encode(), np.uint8)
    blank = (raw == 32) | ((raw >= 9) & (raw <= 13))
    ends = np.flatnonzero(~blank & np.r_[blank[1:], True]) + 1 if len(raw) else np.empty(0, np.int64)
    if len(raw) and blank[-1]:
        ends = np.r_[ends, len(raw)]
    return ends if len(raw) == len(text) else np.cumsum((raw & 0xC0) != 0x80)[ends - 1]


def draws(doc_id: int | None, seed: int = SEED) -> list[int]:
    """Four numbers below 2**32 for a document; a null id is the empty string."""
    digits = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digits[i : i + 8], 16) for i in range(0, 32, 8)]


def transformed(doc_id: int | None, text: str, seed: int = SEED, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT) -> tuple[int, str, int | None, int | None, str]:
    """Units, form, code points of the prefix and of the middle, and the output."""
    ends = unit_ends(text)
    n = len(ends)
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not text or h3 % 100 >= fim_percent or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    units = SkipList(ends)
    first, second = sorted((units.place(h1 % (n + 1)), units.place(h2 % (n + 1))))
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    if h4 % 100 < spm_percent:
        return n, "spm", first, second - first, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", first, second - first, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def fill_in_middle(docs: DataFrame, seed: int = SEED, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, output)``, a row for each
    row of ``docs``.

    ``n`` counts the units, ``form`` is plain, psm or spm, the lengths are in
    code points (null if plain).  A null text is empty, and an empty one plain,
    as is one that holds a marker.  Rows that repeat, share an id or have a null
    one keep a row each (equal ids draw equal numbers, a null id draws as the
    empty string).  Texts are taken whole, whatever their length.  Other columns
    are not read, so their names can't clash.  An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        rows: list[tuple] = []
        size = 0

        def made() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [()] * len(types)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], [f.split()[0] for f in ROW.split(", ")])

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows.append((doc, *transformed(doc, text.as_py() or "", seed, fim_percent, spm_percent)))
                size += len(rows[-1][-1])
                if size > HELD:
                    yield made()
                    rows.clear()
                    size = 0
        yield made()

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, ROW)


def restored(output: str | Column = "output", form: str | Column = "form") -> Column:
    """The text that ``output`` in ``form`` was made of.  A transformed text
    holds no marker of its own, so the output has the three it was given."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    parts = F.split(output, MARKER)
    part = [F.get(parts, F.lit(i)) for i in range(4)]
    return F.when(form == "psm", F.concat(part[1], part[3], part[2])).when(form == "spm", F.concat(part[2], part[3], part[1])).otherwise(output)
