"""Secret scans over a text and everything nested in it.

A stack of layers starts with the text itself.  Each layer is scanned with
the same patterns, and each decoding that applies to it puts a new layer on
the stack: URL escapes, Unicode escapes, base64 runs, and compressed bytes
(gzip, zlib, bzip2, xz; all members, at all places) inside base64 or hex runs
and in layers that are bytes themselves, as what was compressed twice.  Base64 that is
wrapped is joined over its line ends; a run that does not open is tried behind
its ``/``, ``-`` and ``_`` and at the other alignments.  A layer whose content
stands above it already is not decoded again, so the work ends, at a fixpoint,
also for data that unpack to themselves.  What lies below a content is found
once and holds at each of its places.  Every span is mapped back through the
layers to code points of the text.

Work is on UTF-8 bytes, where the patterns' letters are ASCII by themselves.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import lzma
import re
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerlens.llm.common import binary

KINDS = ("assign", "access", "hex")
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ASSIGN = re.compile(rb"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]{16,}")
HEX = re.compile(rb"[0-9a-f]{24,}")
ASSIGN_VALUE = 6

URL_ESCAPE = re.compile(rb"%([0-9A-Fa-f]{2})")
UNICODE_ESCAPE = re.compile(rb"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})|&#[xX]([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});")
BASE64_RUN = re.compile(rb"[A-Za-z0-9+/_-]{16,}={0,2}")
HEX_RUN = re.compile(rb"[0-9a-fA-F]{32,}")
#: Lines of base64 as mail and key files wrap it; the last one may be shorter.
WRAPPED = re.compile(rb"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{32,}+(?:[\x20\t]*+\r?\n[\x20\t]*+[A-Za-z0-9+/_-]++)++={0,2}")
WRAPPED_LINE = re.compile(rb"[A-Za-z0-9+/_-]+=*")
SEPARATOR = re.compile(rb"[/_-]")
#: Where compressed data may begin.
MAGIC = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]|BZh[1-9]|\xfd7zXZ\x00")
#: ASCII text in decoded bytes that are no text as a whole.
STRETCH = re.compile(rb"[\t\n\r\x20-\x7e]{16,}")
#: Unpacked data is a layer in pieces of so many bytes, each of which begins with the end of the one before.
PIECE, OVERLAP, STEP = 32 << 20, 4 << 20, 1 << 20

Span = tuple[int, int]
Back = Callable[[int, int], Span]


def find(raw: bytes) -> Iterator[tuple[int, int, int]]:
    """``(kind, start, end)`` in bytes, leftmost and non-overlapping by kind."""
    low = raw.lower()
    if any(k in low for k in KEYWORDS):
        for m in ASSIGN.finditer(raw):
            if len(m[1]) >= ASSIGN_VALUE:
                yield 0, m.start(), m.end()
    if b"AKIA" in raw:
        for m in ACCESS.finditer(raw):
            yield 1, m.start(), m.end()
    for m in HEX.finditer(raw):
        yield 2, m.start(), m.end()


def _unescape(raw: bytes, pattern: re.Pattern, value: Callable[[re.Match], bytes | None]) -> tuple[bytes, Back] | None:
    """``raw`` with every escape replaced, and the way back from its spans."""
    out, edges, shifts, at, length = [], [0], [(0, 0)], 0, 0
    for m in pattern.finditer(raw):
        if (made := value(m)) is None:
            continue
        out += [raw[at : m.start()], made]
        length += m.start() - at
        edges += [length, length + len(made)]  # made's bytes all stand for the whole escape
        shifts += [(m.start(), m.end()), (m.end(), 0)]
        length += len(made)
        at = m.end()
    if len(edges) == 1:
        return None
    out.append(raw[at:])

    def back(s: int, e: int) -> Span:
        i, j = bisect_right(edges, s) - 1, bisect_right(edges, e - 1) - 1
        start = shifts[i][0] + (0 if shifts[i][1] else s - edges[i])
        end = shifts[j][1] or shifts[j][0] + e - edges[j]
        return start, end

    return b"".join(out), back


def _code_point(m: re.Match) -> bytes | None:
    digits = next((g for g in m.groups()[:5] if g), None)
    point = int(digits, 16) if digits else int(m[6])
    if point > 0x10FFFF or 0xD800 <= point < 0xE000:
        return None
    return chr(point).encode()


def _decompressor(raw: bytes):
    if raw[:1] in (b"\x1f", b"\x78"):
        return zlib.decompressobj(wbits=47)
    return bz2.BZ2Decompressor() if raw[:3] == b"BZh" else lzma.LZMADecompressor()


def _steps(raw: bytes | memoryview, rest: list[int]) -> Iterator[bytes]:
    """What ``raw`` unpacks to, member after member, up to the first fault; at
    the end of a member, ``rest`` gets the number of bytes behind it."""
    while MAGIC.match(raw):
        d, data = _decompressor(raw), raw
        while not d.eof:
            try:
                part = d.decompress(data, STEP)
            except (zlib.error, OSError, EOFError, lzma.LZMAError, ValueError):
                return
            data = getattr(d, "unconsumed_tail", b"")
            if part:
                yield part
            elif not d.eof and not data and getattr(d, "needs_input", True):
                return  # cut off
        raw = d.unused_data.lstrip(b"\0")
        rest.append(len(raw))


def _pieces(steps: Iterable[bytes]) -> Iterator[bytes]:
    held, new = bytearray(), 0
    for part in steps:
        held += part
        new += len(part)
        if len(held) >= PIECE:
            yield bytes(held)
            held, new = held[-OVERLAP:], 0
    if new:
        yield bytes(held)


def _streams(raw: bytes) -> Iterator[tuple[bytes, int]]:
    """Pieces of what is compressed in ``raw``, and where that begins."""
    at = 0
    while m := MAGIC.search(raw, at):
        found, rest = False, []
        for piece in _pieces(_steps(memoryview(raw)[m.start() :], rest)):
            found = True
            yield piece, m.start()
        at = len(raw) - rest[-1] if found and rest else m.start() + 1


def _is_bytes(raw: bytes) -> bool:
    """No text at all, so that compressed data may stand in it as it is."""
    try:
        return not (raw.isascii() or raw.decode() is not None)
    except UnicodeDecodeError:
        return True


def _is_text(raw: bytes) -> bool:
    try:
        text = raw.decode()
    except UnicodeDecodeError:
        return False
    return sum(c.isprintable() or c in "\t\n\r" for c in text) >= 0.9 * len(text)


def _opened(raw: bytes) -> Iterator[tuple[bytes, int | None]]:
    """Decoded bytes as layers: as they are, if text (and where), or unpacked,
    from wherever compressed data begins (None)."""
    if raw and _is_text(raw):
        yield raw, 0
        return
    for piece, _ in _streams(raw):
        yield piece, None


def _decoded(run: bytes) -> bytes:
    run = run.rstrip(b"=")
    run = run[: len(run) - (len(run) % 4 == 1)]
    return base64.b64decode(run.translate(_URL_SAFE) + b"=" * (-len(run) % 4))


def _base64_layers(run: bytes) -> Iterator[tuple[bytes, int, int | None]]:
    """``(layer, characters before it, its place in what they decode to)``.
    The first way of reading the run that opens counts; if none does, the
    stretches of text at any alignment."""
    length = len(run.rstrip(b"="))
    starts = dict.fromkeys([0, *(m.end() for m in SEPARATOR.finditer(run)), 1, 2, 3])
    for start in starts:
        if length - start >= 8:
            found = False
            for layer, at in _opened(_decoded(run[start:])):
                found = True
                yield layer, start, at
            if found:
                return
    for start in range(4):
        for m in STRETCH.finditer(_decoded(run[start:])):
            yield m[0], start, m.start()


def layers_in(raw: bytes) -> Iterator[tuple[bytes, Back]]:
    """The layers one decoding below ``raw``, each with its way back."""
    if _is_bytes(raw):
        for piece, start in _streams(raw):
            yield piece, _blocks(start, len(raw), None)
    if b"%" in raw and (made := _unescape(raw, URL_ESCAPE, lambda m: bytes([int(m[1], 16)]))):
        yield made
    if (b"\\" in raw or b"&#" in raw) and (made := _unescape(raw, UNICODE_ESCAPE, _code_point)):
        yield made
    for m in BASE64_RUN.finditer(raw):
        for layer, start, at in _base64_layers(m[0]):
            yield layer, _blocks(m.start(), m.end(), None) if at is None else _blocks(m.start() + start, m.end(), (3, 4), at)
    for m in WRAPPED.finditer(raw):
        yield from _wrapped_layers(m)
    for m in HEX_RUN.finditer(raw):
        for start in (0, 1):
            digits = m[0][start : start + (len(m[0]) - start & ~1)]
            found = False
            for layer, at in _opened(bytes.fromhex(digits.decode())):
                found = True
                yield layer, _blocks(m.start(), m.end(), None) if at is None else _blocks(m.start() + start, m.end(), (1, 2), at)
            if found:
                break


def _wrapped_layers(m: re.Match) -> Iterator[tuple[bytes, Back]]:
    """Lines of one width, and a last one no wider, read as one run; then
    without the last, which may be an ordinary word."""
    lines = [(x.start() + m.start(), x[0]) for x in WRAPPED_LINE.finditer(m[0])]
    while len(lines) > 1:
        width = len(lines[0][1])
        n = next((i for i, (_, x) in enumerate(lines) if len(x) != width), len(lines))
        block = lines[: n + (n < len(lines) and len(lines[n][1]) < width)]
        for some in (block, lines[:n]) if len(block) > n else (block,):
            if len(some) < 2:
                break
            ends = [0]
            for _, x in some:
                ends.append(ends[-1] + len(x))
            found = False
            for layer, start, at in _base64_layers(b"".join(x for _, x in some)):
                found = True
                whole = some[0][0], some[-1][0] + len(some[-1][1])
                yield layer, _blocks(*whole, None) if at is None else _over_lines(some, ends, start, at)
            if found:
                break
        lines = lines[max(1, n) :]


def _over_lines(lines: list[tuple[int, bytes]], ends: list[int], first: int, at: int) -> Back:
    """Back from bytes decoded of joined lines, through places in the joined run."""
    inner = _blocks(first, ends[-1], (3, 4), at)

    def place(p: int) -> int:
        i = min(bisect_right(ends, p), len(lines)) - 1
        return lines[i][0] + p - ends[i]

    def back(s: int, e: int) -> Span:
        s, e = inner(s, e)
        return place(s), place(e - 1) + 1

    return back


_URL_SAFE = bytes.maketrans(b"-_", b"+/")


def _blocks(start: int, end: int, ratio: tuple[int, int] | None, at: int = 0) -> Back:
    """Back from decoded bytes, of which a layer begins at ``at``: to the
    blocks that hold them, or (unpacked bytes) to the whole run."""
    if ratio is None:
        return lambda s, e: (start, end)
    n, wide = ratio
    return lambda s, e: (start + (s + at) // n * wide, min(end, start + -(-(e + at) // n) * wide))


class _Layer:
    """A layer in work: its spans and those found below it, in its own bytes."""

    def __init__(self, raw: bytes, mark: bytes, up: Back | None, depth: int):
        self.mark, self.up, self.cut = mark, up, depth
        self.spans = set(find(raw))
        self.inner = layers_in(raw)  # made one by one, so that a chain holds one layer

    def add(self, spans: Iterable[tuple[int, int, int]], up: Back) -> None:
        self.spans.update((k, *up(s, e)) for k, s, e in spans)


def scan(raw: bytes) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]], int]:
    """Base spans, all spans (both ``(start, kind, end)`` in bytes of the
    text, sorted) and the number of layers below the text."""
    base = sorted((s, k, e) for k, s, e in find(raw))
    known: dict[bytes, set[tuple[int, int, int]]] = {}
    seen = {top := hashlib.sha256(raw).digest()}
    above = {top: 0}
    stack = [_Layer(raw, top, None, 0)]
    while True:
        layer = stack[-1]
        for inner, up in layer.inner:
            mark = hashlib.sha256(inner).digest()
            seen.add(mark)
            if mark in above:
                layer.add(find(inner), up)
                layer.cut = min(layer.cut, above[mark])
            elif mark in known:
                layer.add(known[mark], up)
            else:
                above[mark] = len(stack)
                stack.append(_Layer(inner, mark, up, len(stack)))
                break
        else:
            stack.pop()
            if not stack:
                return base, sorted((s, k, e) for k, s, e in layer.spans), len(seen) - 1
            del above[layer.mark]
            if layer.cut >= len(stack):  # not cut at a layer further up, which another place may lack
                known[layer.mark] = layer.spans
            stack[-1].add(layer.spans, layer.up)
            stack[-1].cut = min(stack[-1].cut, layer.cut)


def _as_text(raw: bytes, spans: list[tuple[int, int, int]]) -> str:
    if not spans:
        return ""
    if raw.isascii():
        return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)
    points = np.r_[0, np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)]  # code points before a byte
    return ",".join(f"{KINDS[k]}:{points[s]}:{points[e]}" for s, k, e in spans)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_layers)``,
    a row for each row of ``docs``.

    Null and empty texts have no spans (and the digest of nothing).  Rows that
    repeat, share an id or have a null one keep a row each.  Spans of equal
    start and kind are ordered by their end; equal ones found in several
    layers appear once.  Texts are scanned whole, one in memory at a time
    beside its batch; what a compressed run unpacks to is scanned in pieces of
    ``PIECE`` bytes that overlap by ``OVERLAP``.  Other columns are not read; no rows give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: tuple[list, ...] = ([], [], [])
            digests, spans, depths = [], [], []
            for value in binary(batch.column(1)):
                raw = value.as_py() or b""
                base, every, depth = scan(raw)
                for k in range(3):
                    counts[k].append(sum(x[1] == k for x in base))
                text = _as_text(raw, base)
                digests.append(hashlib.sha256(text.encode()).hexdigest())
                spans.append(text if len(every) == len(base) else _as_text(raw, every))
                depths.append(depth)
            columns = [pa.array(c, pa.int64()) for c in counts] + [pa.array(digests, pa.string()), pa.array(spans, pa.string()), pa.array(depths, pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_layers"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string"))
    return rows.mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_layers long")
