"""Secrets in texts and in what the texts wrap: percent escapes, Unicode escapes, base64 and compressed data, however deeply nested.

A text is the first layer of a worklist. Each layer is scanned whole; then everything of the outermost kind of wrapping that it holds is
opened in place, which gives the next layer with a list of the pieces that changed. The work ends at the fixpoint, or where a layer comes
back that was there before. A secret of a layer is mapped through the pieces of all layers above to code points of the text: one
percent escape or base64 digit at a time where the wrapping keeps places, the whole piece where it does not (compression). Opening in place
keeps what stands around a piece, so a key word in the clear and its wrapped value meet in one layer.

One pass over the texts, without a shuffle; the work of a text is its length times the depth of its wrapping.

Defined results: a null text is an empty one; repeated rows give repeated rows; further columns of the input are ignored; an empty table
gives an empty result. A span is listed once, however many layers hold it. Compressed data that opens to more than OPENED bytes stays
closed, which bounds the memory of a task; what can be seen without opening it is still found.
"""

from __future__ import annotations

import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agenda_engine.llm.common import each_batch, pick

# The kinds in the order of their listing, their patterns, and the least length of what they find.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
LEAST_VALUE = 8
#: A whole run matches, so a run that is too short holds no match at all, and the least length can stand in the pattern.
ACCESS, HEX = re.compile("AKIA[A-Z0-9]{12,}"), re.compile("[0-9a-f]{32,}")

PERCENT = re.compile("(?:%[0-9A-Fa-f]{2})+")
ESCAPED = re.compile(r"(?:\\x[0-9A-Fa-f]{2})+|\\u[dD][89abAB][0-9A-Fa-f]{2}\\u[dD][c-fC-F][0-9A-Fa-f]{2}|\\u[0-9A-Fa-f]{4}|\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8}|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};")
#: Base64 of either alphabet; lines of one block may be broken.
RUN = "[A-Za-z0-9+/_-]{16,}"
BASE64 = re.compile(rf"{RUN}(?:\r?\n{RUN})*={{0,2}}")
STANDARD = str.maketrans("-_", "+/", "\r\n=")
CONTROL = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]")
#: Bytes that compressed data may open to.
OPENED = 64 << 20


class Piece(NamedTuple):
    """Code points [low, high) of a layer that stand for [start, end) of the layer above; each of their UTF-8 bytes for up / down places, or 0."""

    low: int
    high: int
    start: int
    end: int
    up: int
    down: int


Span = tuple[int, int, int]


def scan(text: str) -> Iterator[Span]:
    """(start, kind, end) of the base matches of a text."""
    for m in ASSIGN.finditer(text):
        if m.end() - m.start(1) >= LEAST_VALUE:
            yield m.start(), 0, m.end()
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            yield m.start(), 1, m.end()
    for m in HEX.finditer(text):
        yield m.start(), 2, m.end()


def _inflate(data: bytes, most: int) -> bytes | None:
    stream = zlib.decompressobj(47)
    out = stream.decompress(data, most + 1)
    return out if stream.eof and len(out) <= most else None


def _stream(make: Callable) -> Callable[[bytes, int], bytes | None]:
    def run(data: bytes, most: int) -> bytes | None:
        stream = make()
        out = stream.decompress(data, most + 1)
        return out if stream.eof and len(out) <= most else None

    return run


def _unframed(data: bytes, most: int) -> bytes | None:
    out = zstandard.ZstdDecompressor(max_window_size=most).stream_reader(data).read(most + 1)
    return out if len(out) <= most else None


# How compressed data begins.
FORMATS = (
    (b"\x1f\x8b", _inflate), (b"x\x01", _inflate), (b"x^", _inflate), (b"x\x9c", _inflate), (b"x\xda", _inflate), (b"BZh", _stream(bz2.BZ2Decompressor)),
    (b"\xfd7zXZ\x00", _stream(lambda: lzma.LZMADecompressor(lzma.FORMAT_XZ, memlimit=OPENED))), (b"\x28\xb5\x2f\xfd", _unframed),
)


def decompressed(data: bytes, most: int = OPENED) -> bytes | None:
    """What compressed data opens to, or None for other data and for more than `most` bytes."""
    for magic, opens in FORMATS:
        if data.startswith(magic):
            try:
                return opens(data, most)
            except (zlib.error, OSError, EOFError, ValueError, lzma.LZMAError, zstandard.ZstdError, MemoryError):
                return None
    return None


def readable(data: bytes) -> tuple[str, bool] | None:
    """The text that unwrapped bytes are, and whether it is their own, byte by byte; compressed data is opened until it is text or comes back."""
    own, seen = True, {hashlib.sha1(data).digest()}
    while (inner := decompressed(data)) is not None:
        data, own = inner, False
        if (mark := hashlib.sha1(data).digest()) in seen:
            return None
        seen.add(mark)
    try:
        text = data.decode()
    except UnicodeDecodeError:
        return None
    return (text, own) if text and not CONTROL.search(text) else None


def percent(text: str) -> Iterator[tuple[int, int, str, int, int]]:
    """start, end, what is inside, and places for a byte, of the percent escapes that are text."""
    for m in PERCENT.finditer(text):
        if inner := readable(bytes.fromhex(m[0].replace("%", ""))):
            yield m.start(), m.end(), inner[0], 3 * inner[1], 1


def escaped(text: str) -> Iterator[tuple[int, int, str, int, int]]:
    """The same of Unicode escapes, as programs and pages write them."""
    for m in ESCAPED.finditer(text):
        said = m[0]
        if said.startswith("\\x"):
            data = bytes.fromhex(said.replace("\\x", ""))
            inner = readable(data) or (data.decode("latin-1"), False)
            yield m.start(), m.end(), inner[0], 4 * inner[1], 1
            continue
        digits = re.findall("[0-9A-Fa-f]+", said.replace("&#x", "&#X")) if said[1] != "#" else [said.strip("&#xX;")]
        codes = [int(d, 10 if said[1] == "#" and said[2] not in "xX" else 16) for d in digits]
        code = codes[0] if len(codes) == 1 else 0x10000 + ((codes[0] & 0x3FF) << 10) + (codes[1] & 0x3FF)
        if code < 0x110000 and not 0xD800 <= code < 0xE000:
            yield m.start(), m.end(), chr(code), 0, 1


def base64(text: str) -> Iterator[tuple[int, int, str, int, int]]:
    """The same of base64: a block of lines, or else each of its lines, or else what stands between slashes, dashes and underscores."""

    def tried(lo: int, hi: int) -> tuple[int, int, str, int, int] | None:
        digits = text[lo:hi].translate(STANDARD)
        if len(digits) < 16 or len(digits) % 4 == 1:
            return None
        try:
            data = binascii.a2b_base64(digits + "=" * (-len(digits) % 4))
        except binascii.Error:
            return None
        inner = readable(data)
        if not inner:
            return None
        even = inner[1] and "\n" not in text[lo:hi]
        return lo, hi, inner[0], 4 * even, 3

    for m in BASE64.finditer(text):
        for apart in ("(?s).+", "[^\r\n]+", "[^/_\r\n-]+"):
            found = [x for p in re.finditer(apart, m[0]) if (x := tried(m.start() + p.start(), m.start() + p.end()))]
            if found:
                yield from found
                break


#: The outermost wrapping first: an escape may stand inside base64 that is sent in an address, never the other way round.
CODECS = (percent, escaped, base64)


def unwrapped(text: str) -> tuple[str, list[Piece]] | None:
    """The next layer and its pieces, or None where nothing opens."""
    for codec in CODECS:
        parts, pieces, at, low = [], [], 0, 0
        for start, end, inside, up, down in codec(text):
            parts += [text[at:start], inside]
            low += start - at
            pieces.append(Piece(low, low + len(inside), start, end, up, down))
            low, at = low + len(inside), end
        if pieces:
            return "".join([*parts, text[at:]]), pieces
    return None


def above(layer: str, pieces: list[Piece], start: int, end: int) -> tuple[int, int]:
    """The span of the layer above that a span of this one stands for."""

    def at(place: int) -> Piece:
        k = bisect_right(pieces, place, key=lambda p: p.low) - 1
        return pieces[k] if k >= 0 else Piece(0, 0, 0, 0, 0, 1)

    first, last = at(start), at(end - 1)
    if start >= first.high:
        low = first.end + start - first.high
    else:
        low = first.start + (len(layer[first.low : start].encode()) * first.up // first.down)
    if end - 1 >= last.high:
        high = last.end + end - last.high
    elif last.up:
        high = min(last.end, last.start - (-len(layer[last.low : end].encode()) * last.up // last.down))
    else:
        high = last.end
    return low, high


def find(text: str) -> tuple[list[Span], list[Span]]:
    """The base spans of a text, and all spans of it and its layers, each as (start, kind, end) in order."""
    base = sorted(scan(text))
    spans, seen, work = set(base), {hashlib.sha1(text.encode("utf-8", "surrogatepass")).digest()}, [(text, ())]
    while work:
        layer, way = work.pop()
        if (inner := unwrapped(layer)) is None:
            continue
        layer, way = inner[0], (inner, way)
        if (mark := hashlib.sha1(layer.encode("utf-8", "surrogatepass")).digest()) in seen:
            continue
        seen.add(mark)
        for start, kind, end in scan(layer):
            step = way
            while step:
                (told, pieces), step = step
                start, end = above(told, pieces, start, end)
            spans.add((start, kind, end))
        work.append((layer, way))
    return base, sorted(spans)


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base and spans (arrays of kind, start, end in code points, by start and kind) of every row."""

    def listed(rows: list[list[Span]]) -> pa.Array:
        flat = [s for row in rows for s in row]
        ends = [0]
        for row in rows:
            ends.append(ends[-1] + len(row))
        struct = pa.StructArray.from_arrays([pa.array([KINDS[s[1]] for s in flat], pa.string()), pa.array([s[0] for s in flat], pa.int64()), pa.array([s[2] for s in flat], pa.int64())], ["kind", "start", "end"])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), struct)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [find(t.as_py() or "") for t in batch.column(1)]
        return pa.record_batch([batch.column(0), listed([b for b, _ in found]), listed([s for _, s in found])], ["doc_id", "base", "spans"])

    span = "array<struct<kind:string,start:bigint,end:bigint>>"
    return each_batch(pick(docs, id_col, text_col), work, f"doc_id long, base {span}, spans {span}")


def digests(found: DataFrame) -> DataFrame:
    """Counts of the base spans, their digest, all spans as one text, and how many of them only a layer shows."""

    def told(column: str):
        return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, KINDS), F.sha2(told("base"), 256).alias("base_sha256"), told("spans").alias("spans"), (F.size("spans") - F.size("base")).cast("long").alias("n_unwrapped"),
    )
