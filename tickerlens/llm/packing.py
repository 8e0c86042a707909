"""Best-fit packing after Martello-Toth reduction.

Documents become token ids, end with id 0, and are cut into pieces only where
they are longer than a sequence.  Lengths are whole numbers up to the
capacity, so the packing instance is a histogram with at most ``capacity``
rows, whatever the corpus holds: the reduction and best-fit work on counts of
equal pieces, and their answer is a short list of runs (this many pieces of
this length, at this offset, in consecutive sequences).  Each piece then
finds its place from its rank among the pieces of its length.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickerlens.llm.common import Memo, binary, cut

CAPACITY = 2048
PIECES_A_BLOCK = 50_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: Letters beyond ASCII that stay one character each, and unchanged by NFC, when lower-cased.
LETTERS, SMALL = "À-ÖØ-öø-įı-ž", "ß-öø-įı-ž"
#: Texts of blanks, printable ASCII and those letters are split by rule.
PLAIN = re.compile(rf"[\x20\x09-\x0D!-~{LETTERS}]*")
#: What the vocabulary's pre-tokenizer matches in them, lower-cased.
PARTS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[a-z{SMALL}]+|[0-9]|[^\x20\x09-\x0Da-z0-9{SMALL}]+")
BLANK = re.compile(r"[\x20\x09-\x0D]")
#: Parts that a worker remembers, also between tasks: some 150 bytes each.
MEMO_LIMIT = 200_000
#: Characters of a text that are split at a time.
AT_ONCE = 1 << 20


def _slices(text: str) -> Iterator[str]:
    """``text``, cut at blanks into slices of about ``AT_ONCE``."""
    at = 0
    while len(text) - at > AT_ONCE and (blank := BLANK.search(text, at + AT_ONCE)):
        yield text[at : blank.start()]
        at = blank.start()
    yield text[at:] if at else text


@lru_cache(maxsize=2)
def text_encoder(path: str) -> Callable[[bytes], bytes]:
    """A text's ids as little-endian bytes.

    This vocabulary's tokenizer drops blanks and never joins across them, nor
    across the parts that its pre-tokenizer makes, so a text's ids are its
    parts' ids in order.  Parts of plain texts are encoded once as long as they
    are remembered; in others the chunks between blanks are looked at singly.
    """
    from tokenizers import Tokenizer, pre_tokenizers

    tokenizer = Tokenizer.from_file(path)
    model = tokenizer.model
    # How the model spells the bytes of a letter.
    spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    spelling = {c: "".join(s for s, _ in spell.pre_tokenize_str(chr(c))) for c in range(0xC0, 0x17F)}

    def as_bytes(ids: list[int]) -> bytes:
        return np.asarray(ids, "<u4").tobytes()

    parts = Memo(lambda part: as_bytes([t.id for t in model.tokenize(part if part.isascii() else part.translate(spelling))]), MEMO_LIMIT)

    def plain(text: str) -> bool:
        return "<|" not in text and PLAIN.fullmatch(text) is not None

    def by_rule(text: str) -> bytes:
        return b"".join(map(parts.__getitem__, PARTS.findall(text.lower())))

    odd = Memo(lambda chunk: as_bytes(tokenizer.encode(chunk, add_special_tokens=False).ids), MEMO_LIMIT // 10)

    def encode(raw: bytes) -> bytes:
        out = []
        for text in _slices(raw.decode()):
            if plain(text):
                out.append(by_rule(text))
            else:
                out += [by_rule(chunk) if plain(chunk) else odd[chunk] for chunk in map(bytes.decode, text.encode().split())]
        return b"".join(out)

    return encode


def tokenised_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each piece of each row of ``docs``; see ``PIECES``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = text_encoder(path)
        step, end = 4 * capacity, bytes(4)
        for batch in batches:
            out: dict[str, list] = {"doc_id": [], "piece": [], "start": [], "length": [], "ids_crc32": []}
            for doc, raw in zip(batch.column(0).to_pylist(), binary(batch.column(1)), strict=True):
                ids = encode(raw.as_py() or b"") + end
                for k, at in enumerate(range(0, len(ids), step)):
                    piece = ids[at : at + step]
                    out["doc_id"].append(doc)
                    out["piece"].append(k)
                    out["start"].append(at // 4)
                    out["length"].append(len(piece) // 4)
                    out["ids_crc32"].append(zlib.crc32(piece))
            types = {"doc_id": pa.int64(), "piece": pa.int32()}
            yield pa.RecordBatch.from_arrays([pa.array(v, types.get(n, pa.int64())) for n, v in out.items()], list(out))

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, PIECES)


class Plan:
    """Where runs of equal pieces go: parallel lists of ``length``, ``rank``
    (of the first of them), ``count``, ``sequence`` (of the first; one each),
    ``offset``."""

    def __init__(self):
        self.length, self.rank, self.count, self.sequence, self.offset = ([] for _ in range(5))
        self.next_rank: dict[int, int] = {}
        self.sequences = 0

    def open(self, n: int) -> int:
        self.sequences += n
        return self.sequences - n

    def put(self, length: int, n: int, sequence: int, offset: int) -> None:
        rank = self.next_rank.get(length, 0)
        self.next_rank[length] = rank + n
        for column, value in ((self.length, length), (self.rank, rank), (self.count, n), (self.sequence, sequence), (self.offset, offset)):
            column.append(value)


def reduce_by_dominance(left: dict[int, int], capacity: int, plan: Plan) -> None:
    """Fix every small set of pieces that provably dominates: whatever else a
    sequence with its longest piece may hold, swapping it for this set leaves
    the rest no harder to pack.  For a longest piece j with room r beside it:

    * {j} if nothing else fits;
    * {j, k}, k the longest that fits, if k fills the room, or no two others
      fit, or no three fit and no two that do are together longer than k.

    Takes what it fixes out of ``left`` and repeats until nothing is fixed.
    """
    moved = True
    while moved:
        moved = False
        for j in sorted(left, reverse=True):
            while left.get(j):
                left[j] -= 1
                lengths = sorted(x for x in left if left[x])
                least = [x for x in lengths[:3] for _ in range(min(3, left[x]))][:3]
                left[j] += 1
                room = capacity - j
                at = bisect_left(lengths, room + 1)
                if not at:
                    n, chosen = left[j], (j,)
                else:
                    k = lengths[at - 1]
                    fixed = k == room or sum(least[:2]) > room or len(least) < 2
                    if not fixed and (len(least) < 3 or sum(least) > room):
                        fixed = _longest_pair(lengths[:at], left, j, room) <= k
                    if not fixed:
                        break
                    n, chosen = (left[j] // 2 if j == k else min(left[j], left[k])), (j, k)
                    if not n:
                        break
                first, offset = plan.open(n), 0
                for x in chosen:
                    plan.put(x, n, first, offset)
                    left[x] -= n
                    offset += x
                moved = True
        for x in [x for x in left if not left[x]]:
            del left[x]


def _longest_pair(lengths: list[int], left: dict[int, int], j: int, room: int) -> int:
    best, lo, hi = 0, 0, len(lengths) - 1
    while lo <= hi:
        total = lengths[lo] + lengths[hi]
        if lo == hi and left[lengths[lo]] - (lengths[lo] == j) < 2 or total > room:
            hi -= 1
        else:
            best = max(best, total)
            lo += 1
    return best


def best_fit(left: dict[int, int], capacity: int, plan: Plan) -> None:
    """Longest first, each into the fullest sequence with room for it.
    Sequences that hold the same lengths are one run [first, first + n)."""
    by_room: dict[int, list[tuple[int, int]]] = {}
    rooms: list[int] = []

    def keep(room: int, first: int, n: int) -> None:
        if n and room:
            if room not in by_room:
                by_room[room] = []
                insort(rooms, room)
            by_room[room].append((first, n))

    for length in sorted(left, reverse=True):
        need = left[length]
        while need:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, n = by_room[room].pop()
                if not by_room[room]:
                    del by_room[room], rooms[at]
            else:
                room, n = capacity, max(1, need // (capacity // length))
                first = plan.open(n)
            each = min(room // length, need)
            used = min(n, need // each)
            keep(room, first + used, n - used)
            for i in range(each):
                plan.put(length, used, first, capacity - room + i * length)
            need -= each * used
            keep(room - each * length, first, used)


def plan_packing(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    plan, left = Plan(), {x: n for x, n in counts.items() if n}
    reduce_by_dominance(left, capacity, plan)
    best_fit(left, capacity, plan)
    return plan


def ranked(pieces: DataFrame, total: int) -> DataFrame:
    """``pieces`` with ``rank``: 0.. within its length.  Lengths are dealt
    over hash blocks, so that no task holds all pieces of a common length."""
    blocks = max(8, total // PIECES_A_BLOCK)
    rows = pieces.withColumn("block", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(blocks)))
    sizes = rows.groupBy("length", "block").agg(F.count("*").alias("n"))
    before = W.partitionBy("length").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    base = sizes.select("length", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = W.partitionBy("length", "block").orderBy("doc_id", "piece", "ids_crc32")
    numbered = rows.withColumn("inside", F.row_number().over(inside) - 1)
    return numbered.join(base, ["length", "block"]).withColumn("rank", F.col("base") + F.col("inside")).drop("block", "base", "inside")


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)``, a
    row for each piece of each row.

    A null or empty text is the one id 0.  Rows that repeat (or share an id,
    or have a null one) are packed each for themselves, since they are never
    joined by id.  A text of any length is cut into full pieces and a rest.
    Ties between pieces of one length go by hash block, id and piece.  Other
    columns are not read.  An empty table gives no rows.
    """
    pieces = cut(tokenised_pieces(docs, path or tokenizer_path(), capacity, id_col, text_col))
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows at most
    plan = plan_packing(counts, capacity)
    span = max([1, *counts.values()])  # ranks are below this
    lookup = np.array(plan.length, np.int64) * span + np.array(plan.rank, np.int64)
    order = np.argsort(lookup, kind="stable")
    lookup, rank, sequence, offset = (np.array(x, np.int64)[order] for x in (lookup, plan.rank, plan.sequence, plan.offset))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, mine = (np.asarray(batch.column(n)) for n in ("length", "rank"))
            run = np.searchsorted(lookup, length * span + mine, side="right") - 1
            columns = [batch.column(n) for n in ("doc_id", "piece", "start", "length", "ids_crc32")]
            columns += [pa.array(sequence[run] + mine - rank[run]), pa.array(offset[run])]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked(pieces, sum(counts.values())).mapInArrow(place, PIECES + ", sequence_id long, offset long")
