"""Removal of long passages that an earlier document holds, by sampled suffixes.

A suffix array of the corpus, sorted only as deep as a match is long, would put equal passages side by side. The
positions that are sorted are a cover: two equal passages of `length` bytes have a sampled position at the same
place. A difference cover by residues gives that with two thirds of all positions (or a sixth, for the
largest cover that fits a passage of 50 bytes), each to be shuffled; here the cover is taken from the content,
the positions whose `gram` bytes have the smallest hash of some window, about one in eighteen. The steps are
those of the difference-cover algorithm, each a shuffle:

1. sample: each sampled suffix gets a name (the hash of its gram) and a hash of its context, all windows that hold
   the gram;
2. sort by name and context, and compare neighbours: a context that a smaller document holds too is covered
   whole, and only the first document of each context is looked at further, where its name has other contexts;
3. merge the remaining suffixes: those with one name meet again with the bytes around them, the windows of these are
   named themselves, and each window that a smaller document has is covered;
4. join what is covered to the texts.

Sampled suffixes travel as packed arrays, a few for each task and bucket of names. Buckets are as many as four
times the shuffle partitions; what they find is dealt to half as many buckets of rows as there are partitions.

Defined results: a null text counts as empty; matches never cross documents and are judged on the input; texts
shorter than a match stay whole; rows without an id are one document, larger than any other; rows with one id are
one document for matches and keep a row each; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agenda_engine.functions.shipping import ship
from agenda_engine.llm.common import cut, parts, pick, release

LENGTH, GRAM = 50, 16
#: Bytes of text that are hashed at once, at eight bytes for each length of string; rows that are dealt to buckets at once.
CHUNK, GATHER = 1 << 18, 400_000
#: Sampled suffixes whose windows are named at once.
AROUND = 4096
MIX, MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
#: Hashes of single bytes; 256 stands for what is beyond a text.
TABLE, TABLE2 = np.random.default_rng(50).integers(1, 2**63, (2, 257), dtype=np.uint64)
NO_ID = np.int64(2**63 - 1)


def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The hash of two neighbouring strings from theirs."""
    x = a * MIX + b
    x ^= x >> np.uint64(29)
    x *= MIX2
    x ^= x >> np.uint64(32)
    return x


class Hashes:
    """Hashes of all strings of some lengths in a sequence of symbols."""

    def __init__(self, symbols: np.ndarray, table: np.ndarray = TABLE):
        self.by: dict[int, np.ndarray] = {1: table[symbols]}

    def of(self, size: int) -> np.ndarray:
        """The hash of the string of that length at each position where there is one."""
        if size not in self.by:
            left = 1 << (size - 1).bit_length() - 1
            a, b = self.of(left), self.of(size - left)
            n = len(self.by[1]) - size + 1
            self.by[size] = _join(a[:n], b[left : left + n])
        return self.by[size]


def _slide(x: np.ndarray, size: int, best) -> np.ndarray:
    """best() of each `size` neighbours."""
    width = 1
    while width < size:
        step = min(width, size - width)
        x = best(x[:-step], x[step:])
        width += step
    return x


def laid_out(texts: list[bytes], margin: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one sequence with a margin of 256 before each and after the last, and where each text starts."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.cumsum(sizes + margin) - sizes
    out = np.full(int((sizes + margin).sum()) + margin, 256, np.int16)
    for start, text in zip(starts.tolist(), texts, strict=True):
        out[start : start + len(text)] = np.frombuffer(text, np.uint8)
    return out, starts


def sample(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Text number, position, name, context, and short hashes of left and right halves of each sampled suffix.

    A position is sampled if its gram has the smallest hash of a window of `length` bytes that lies in the text.
    """
    width = length - gram + 1
    symbols, starts = laid_out(texts, width - 1)
    hashes = Hashes(symbols)
    grams = hashes.of(gram)
    beyond = np.concatenate([[0], np.cumsum(symbols == 256)])
    least = _slide(grams, width, np.minimum)
    least[beyond[length:] != beyond[:-length]] = 0
    around = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    at = np.flatnonzero((_slide(around, width, np.maximum) == grams) & (beyond[gram:] == beyond[:-gram]))
    number = np.searchsorted(starts, at, side="right") - 1
    whole = hashes.of(length + width - 1)
    half = (width - 1) // 2 + gram
    left, right = hashes.of(half)[at - (width - 1) // 2], hashes.of(half)[at]
    return number, at - starts[number], grams[at], whole[at - width + 1], left.astype(np.uint16), right.astype(np.uint16)


def slices(n: int, length: int = LENGTH) -> Iterator[tuple[int, int, int, int]]:
    """Parts of a text of n bytes: where each starts and ends with a margin, and the positions that it answers for.

    All that tells whether a position is sampled, and its context, lies within two lengths of it.
    """
    for lo in range(0, n, CHUNK):
        hi = min(lo + CHUNK, n)
        yield max(0, lo - 2 * length), min(n, hi + 2 * length), lo, hi


def chunks(batches: Iterator[pa.RecordBatch], length: int = LENGTH) -> Iterator[list[tuple[int, int, int, int, int, bytes]]]:
    """Groups of about CHUNK bytes of doc, row, start, first and last position to answer for, and bytes; a long text is several of these."""
    group, size = [], 0
    for batch in (p for b in batches for p in parts(b)):
        for doc, row, text in zip(*(batch.column(k).to_pylist() for k in ("doc", "row", "text")), strict=True):
            data = text.encode()
            for start, end, lo, hi in slices(len(data), length):
                group.append((doc, row, start, lo, hi, data[start:end]))
                size += end - start
                if size >= CHUNK:
                    yield group
                    group, size = [], 0
    if group:
        yield group


def suffixes(group: list[tuple[int, int, int, int, int, bytes]], length: int = LENGTH, gram: int = GRAM) -> dict[str, np.ndarray]:
    """The sampled suffixes of a group, as the columns of SUFFIX."""
    docs, keys, start, lo, hi = (np.array(c, np.int64) for c in list(zip(*group, strict=True))[:5])
    number, at, name, context, left, right = sample([g[5] for g in group], length, gram)
    at = at + start[number]
    own = (at >= lo[number]) & (at < hi[number])
    number, context = number[own], context[own]
    found = (name[own], context.astype(np.uint32), (context >> np.uint64(32)).astype(np.uint16), left[own], right[own], docs[number], keys[number], at[own].astype(np.int32))
    return dict(zip(SUFFIX, found, strict=True))


def gathered(parts: Iterator[dict[str, np.ndarray]], most: int) -> Iterator[dict[str, np.ndarray]]:
    """Columns put together until they have `most` rows, so that what is dealt to many buckets stays in few blobs."""
    held, n = [], 0
    for part in parts:
        held.append(part)
        n += len(next(iter(part.values())))
        if n >= most:
            yield {k: np.concatenate([h[k] for h in held]) for k in part}
            held, n = [], 0
    if n:
        yield {k: np.concatenate([h[k] for h in held]) for k in held[0]}


def pack(columns: dict[str, np.ndarray]) -> bytes:
    """Columns one after the other, which compresses better than rows."""
    return b"".join(np.ascontiguousarray(c).tobytes() for c in columns.values())


def unpack(blobs: list[bytes], kinds: dict[str, str]) -> dict[str, np.ndarray]:
    """The columns of all blobs."""
    width = sum(np.dtype(k).itemsize for k in kinds.values())
    parts: dict[str, list[np.ndarray]] = {k: [] for k in kinds}
    for blob in blobs:
        n, offset = len(blob) // width, 0
        for name, kind in kinds.items():
            parts[name].append(np.frombuffer(blob, kind, n, offset))
            offset += n * np.dtype(kind).itemsize
    return {k: np.concatenate(v) if v else np.zeros(0, kinds[k]) for k, v in parts.items()}


def dealt(bucket: np.ndarray, columns: dict[str, np.ndarray]) -> list[tuple[int, bytes]]:
    """Rows of bucket and blob."""
    order = np.argsort(bucket, kind="stable")
    ends = np.flatnonzero(np.diff(bucket[order], append=-1) != 0) + 1
    out, lo = [], 0
    for hi in ends.tolist():
        rows = order[lo:hi]
        out.append((int(bucket[rows[0]]), pack({k: v[rows] for k, v in columns.items()})))
        lo = hi
    return out


def _blobs(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([b for b, _ in rows], pa.int32()), pa.array([d for _, d in rows], pa.binary())], ["bucket", "data"])


SUFFIX = {"name": "<u8", "context": "<u4", "more": "<u2", "left": "<u2", "right": "<u2", "doc": "<i8", "row": "<i8", "at": "<i4"}
SPOT = {"row": "<i8", "at": "<i4", "open": "u1"}
AROUND_KINDS = {"name": "<u8", "doc": "<i8", "row": "<i8", "at": "<i4", "open": "u1", "before": "<u2", "after": "<u2"}
BLOB = "bucket int, data binary"


def _new(*columns: np.ndarray) -> np.ndarray:
    """True where any of some sorted columns differs from the row before."""
    out = np.ones(len(columns[0]), bool)
    if len(out):
        out[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return out


def _shared(group: np.ndarray, half: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """True where another document of the group has the same half."""
    if not len(group):
        return np.zeros(0, bool)
    order = np.lexsort((doc, half, group))
    g, h, d = group[order], half[order], doc[order]
    first = np.flatnonzero(_new(g, h))
    last = np.append(first[1:], len(order)) - 1
    out = np.empty(len(order), bool)
    out[order] = np.repeat(d[first] != d[last], last - first + 1)
    return out


def compare(rows: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The suffixes of a bucket whose context is covered (open 0), and those with windows to compare: to the left (open 1), to the right (2) or both (3)."""
    order = np.lexsort((rows["at"], rows["doc"], rows["more"], rows["context"], rows["name"]))
    name, context, more, doc, left, right = (rows[k][order] for k in ("name", "context", "more", "doc", "left", "right"))
    first = np.flatnonzero(_new(name, context, more))
    owner = np.repeat(doc[first], np.diff(np.append(first, len(name))))
    covered = doc > owner
    group = np.cumsum(_new(name))
    rest = np.flatnonzero(~covered)
    sides = _shared(group[rest], left[rest], doc[rest]) + 2 * _shared(group[rest], right[rest], doc[rest]).astype(np.uint8)
    rest, sides = rest[sides > 0], sides[sides > 0]
    chosen = order[np.concatenate([np.flatnonzero(covered), rest])]
    return {"row": rows["row"][chosen], "at": rows["at"][chosen], "open": np.concatenate([np.zeros(int(covered.sum()), np.uint8), sides.astype(np.uint8)])}


def repeated(rows: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The windows of a bucket that a smaller document has."""
    order = np.lexsort((rows["doc"], rows["more"], rows["name"]))
    name, more, doc = (rows[k][order] for k in ("name", "more", "doc"))
    first = np.flatnonzero(_new(name, more))
    chosen = order[doc > np.repeat(doc[first], np.diff(np.append(first, len(name))))]
    return {"row": rows["row"][chosen], "at": rows["at"][chosen], "open": np.zeros(len(chosen), np.uint8)}


def around(text: bytes, at: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all windows that hold the gram at each position, a row each with the gram in the middle, and how many of them lie in the text before and from the position on."""
    width = length - gram + 1
    data = np.concatenate([np.zeros(width - 1, np.uint8), np.frombuffer(text, np.uint8), np.zeros(length, np.uint8)])
    rows = np.lib.stride_tricks.sliding_window_view(data, length + width - 1)[at] if len(at) else np.zeros((0, length + width - 1), np.uint8)
    return rows, np.minimum(at, width - 1), np.minimum(len(text) - at, length)


def named_windows(rows: np.ndarray, before: np.ndarray, after: np.ndarray, sides: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Row, start from the sampled position, and name (128 bits in two) of the windows whose sampled suffix is in the middle of a row, on the sides that are asked for."""
    width, half = length - gram + 1, (length - gram) // 2
    found = []
    for lo in range(0, len(rows), AROUND):
        own = slice(lo, lo + AROUND)
        symbols = rows[own].ravel()
        hashes = Hashes(symbols)
        grams = hashes.of(gram)
        back = np.arange(width)[None, :]
        middle = np.arange(len(rows[own]))[:, None] * rows.shape[1] + width - 1
        ok = (back <= before[own, None]) & (length - back <= after[own, None])
        ok &= ((sides[own, None] & 1 > 0) & (back >= half)) | ((sides[own, None] & 2 > 0) & (width - 1 - back >= half))
        ok &= _slide(grams, width, np.minimum)[middle - back] == grams[middle]
        number, back = np.nonzero(ok)
        start = middle[number, 0] - back
        found.append((number + lo, -back, hashes.of(length)[start], Hashes(symbols, TABLE2).of(length)[start]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def windows(text: bytes, at: np.ndarray, sides: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and names (128 bits in two) of the windows whose sampled suffix is one of some positions, on the sides that are asked for."""
    number, start, name, more = named_windows(*around(text, at, length, gram), sides, length, gram)
    starts, first = np.unique(at[number] + start, return_index=True)
    return starts, name[first], more[first]


def met_windows(rows: dict[str, np.ndarray], length: int = LENGTH, gram: int = GRAM) -> dict[str, np.ndarray]:
    """The windows around the suffixes of a bucket that a smaller document has; those of few names at once, since equal windows have one sampled gram."""
    order = np.argsort(rows["name"], kind="stable")
    ends = np.append(np.flatnonzero(np.diff(rows["name"][order])) + 1, len(order))
    found, lo = [], 0
    while lo < len(order):
        hi = int(ends[np.searchsorted(ends, min(lo + AROUND, len(order)))])
        own = order[lo:hi]
        texts = np.frombuffer(rows["text"][own].tobytes(), np.uint8).reshape(len(own), -1)
        number, start, name, more = named_windows(texts, rows["before"][own], rows["after"][own], rows["open"][own], length, gram)
        mine = own[number]
        found.append(repeated({"name": name, "more": more, "doc": rows["doc"][mine], "row": rows["row"][mine], "at": (rows["at"][mine] + start).astype(np.int32)}))
        lo = hi
    return {k: np.concatenate([f[k] for f in found]) if found else np.zeros(0, t) for k, t in SPOT.items()}


def covered_bytes(n: int, contexts: np.ndarray, starts: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> np.ndarray:
    """True for each byte of a text of n bytes that lies in a covered context or window."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, np.maximum(contexts - (length - gram), 0), 1)
    np.add.at(edge, np.minimum(contexts + length, n), -1)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + length, -1)
    return np.cumsum(edge[:-1]) > 0


def _of(key: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each key."""
    return (_join(np.ascontiguousarray(key).view(np.uint64), np.zeros(1, np.uint64)) % np.uint64(buckets)).astype(np.int32)


def _buckets(df: DataFrame) -> tuple[int, int]:
    """Buckets of names and of rows. Spots are few and narrow beside suffixes, so fewer buckets of them hold as much, and blobs stay fewer."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return 4 * max(1, partitions), max(1, partitions // 2)


def _by_bucket(df: DataFrame, kinds: dict[str, str], work) -> DataFrame:
    """work() on the rows of all blobs of a bucket; what comes back is dealt out by row."""
    _, by_row = _buckets(df)

    def run(table: pa.Table) -> pa.Table:
        found = work(unpack(table.column("data").to_pylist(), kinds))
        out = pa.Table.from_batches([_blobs(dealt(_of(found["row"], by_row), found))])
        del found
        release()
        return out

    return df.groupBy("bucket").applyInArrow(run, BLOB)


def _by_row(df: DataFrame) -> DataFrame:
    """row, at (packed positions) and open (packed flags) from blobs of spots: a row for each document that has any."""

    def run(table: pa.Table) -> pa.Table:
        spots = unpack(table.column("data").to_pylist(), SPOT)
        order = np.lexsort((spots["at"], spots["row"]))
        row, at, opened = (spots[k][order] for k in SPOT)
        first = np.flatnonzero(_new(row))
        parts = [(int(row[a]), at[a:b].tobytes(), opened[a:b].tobytes()) for a, b in zip(first, np.append(first[1:], len(row)), strict=True)]
        kinds = (pa.int64(), pa.binary(), pa.binary())
        return pa.table([pa.array([p[i] for p in parts], k) for i, k in enumerate(kinds)], names=["row", "at", "open"])

    return df.groupBy("bucket").applyInArrow(run, "row long, at binary, open binary")


def zipped(rows: DataFrame) -> DataFrame:
    """Rows with the text compressed, as column zipped, as it goes through a shuffle."""
    place = rows.columns.index("text")
    names = ["zipped" if c == "text" else c for c in rows.columns]
    kinds = ", ".join("zipped binary" if f.name == "text" else f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for b in batches for p in parts(b)):
            data = pa.array([zlib.compress(t.encode(), 1) for t in batch.column(place).to_pylist()], pa.binary())
            yield pa.record_batch([data if i == place else c for i, c in enumerate(batch.columns)], names)
        release()

    return rows.mapInArrow(run, kinds)


def spots(rows: DataFrame, length: int = LENGTH, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """For rows of doc, row and text: (row, at, open) of sampled suffixes and (row, starts) of covered windows."""
    ship(rows.sparkSession)
    buckets, _ = _buckets(rows)
    width = length - gram + 1

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in gathered((suffixes(g, length, gram) for g in chunks(batches, length)), GATHER):
            yield _blobs(dealt(_of(columns["name"], buckets), columns))
            del columns
        release()

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[dict[str, np.ndarray]]:
            for batch in batches:
                for doc, row, data, at, opened in zip(*(batch.column(k).to_pylist() for k in ("doc", "row", "zipped", "at", "open")), strict=True):
                    sides = np.frombuffer(opened, "u1")
                    where = np.frombuffer(at, "<i4")[sides > 0]
                    texts, before, after = around(zlib.decompress(data), where, length, gram)
                    name = Hashes(np.ascontiguousarray(texts[:, width - 1 : length]).ravel()).of(gram)[::gram] if len(where) else np.zeros(0, np.uint64)
                    found = (name, np.full(len(where), doc), np.full(len(where), row), where, sides[sides > 0], before, after, texts)
                    yield {k: v.astype(t, copy=False) for (k, t), v in zip((AROUND_KINDS | {"text": "u1"}).items(), found, strict=True)}

        for columns in gathered(each(), GATHER // 4):
            yield _blobs(dealt(_of(columns["name"], buckets), columns))
            del columns
        release()

    long = rows.where(F.octet_length("text") >= length)
    found = cut(_by_row(_by_bucket(long.mapInArrow(sampled, BLOB), SUFFIX, compare)))
    opened = found.where(F.translate(F.hex("open"), "0", "") != "")
    met = zipped(long).join(opened, "row")
    met_again = _by_bucket(met.mapInArrow(named, BLOB), AROUND_KINDS | {"text": f"V{length + width - 1}"}, lambda found: met_windows(found, length, gram))
    again = cut(_by_row(met_again))
    return found, again.select("row", F.col("at").alias("starts"))


def deduplicate(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the bytes that stay) and kept_text of every input row.

    kept_text leaves out bytes that no longer make a character. Columns to carry come along as they are.
    """
    carried = [docs[c].alias(f"carried_{i}") for i, c in enumerate(carry)]
    key = [docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("body")]
    rows = docs.select(*key, *carried).select(
        F.coalesce("doc_id", F.lit(int(NO_ID))).alias("doc"), F.xxhash64("doc_id", "body").alias("row"), F.coalesce("body", F.lit("")).alias("text"), *(f"carried_{i}" for i in range(len(carry)))
    )
    found, again = spots(rows.select("doc", "row", "text"), length, gram)
    met = zipped(rows).join(found, "row", "left").join(again, "row", "left")
    own = [f"carried_{i}" for i in range(len(carry))]
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "kept_text", *own]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for b in batches for p in parts(b)):
            out = []
            for doc, data, at, opened, starts in zip(*(batch.column(k).to_pylist() for k in ("doc", "zipped", "at", "open", "starts")), strict=True):
                text = zlib.decompress(data)
                contexts = np.frombuffer(at or b"", "<i4").astype(np.int64)[np.frombuffer(opened or b"", "u1") == 0]
                gone = covered_bytes(len(text), contexts, np.frombuffer(starts or b"", "<i4").astype(np.int64), length, gram)
                kept = np.frombuffer(text, np.uint8)[~gone].tobytes() if gone.any() else text
                runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                out.append((None if doc == NO_ID else doc, len(text), len(text) - len(kept), runs, hashlib.sha256(kept).hexdigest(), kept, kept.decode("utf-8", "ignore")))
            if out:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.string())
                columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.record_batch([*columns, *(batch.column(k) for k in own)], names)
        release()

    kinds = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, kept_text string"
    kinds += "".join(f", carried_{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(carry))
    done = met.mapInArrow(run, kinds)
    return done.select(*names[:7], *(F.col(f"carried_{i}").alias(c) for i, c in enumerate(carry)))
