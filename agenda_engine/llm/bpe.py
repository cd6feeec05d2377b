"""Byte-level BPE encoding and decoding with a segment tree over adjacent pair ranks.

A leaf holds rank * width + place of the pair that starts at its symbol, or NONE; an inner node holds the
smaller of its two children. The root is thus the leftmost pair of the lowest rank. A merge changes three
leaves (the pair itself, the one before and the one that vanishes) and their ancestors, and merging ends when
the root is NONE. Short pre-tokens are merged many at a time, one array row each; longer ones one by one with
the same tree.

Texts are taken apart at single spaces, where no pre-token of the pattern continues, and each worker keeps
the encodings of a bounded number of such segments. Decoding goes from ids back to bytes.

Defined results: a null text counts as empty, with no ids; a text of any length is encoded whole; repeated
rows keep a row each; any further columns of the input are ignored.
"""

from __future__ import annotations

import json
import re as plain
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agenda_engine.llm.common import each_batch, pick

PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NONE = np.int64(2**62)
#: Widths of the trees that are merged many at a time, rows in one such step, and segments that a worker remembers.
WIDTHS, ROWS, MEMORY = (8, 16, 32, 64), 20_000, 400_000


def byte_letters() -> list[str]:
    """The printable letter of each byte: printable Latin-1 stands for itself, the others follow from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    moved = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(moved)) for b in range(256)]


class Encoder:
    """Encodes and decodes texts by the vocabulary of a byte-level BPE tokenizer file."""

    def __init__(self, content: str):
        import regex

        file = json.loads(content)
        vocab, merges = file["model"]["vocab"], file["model"]["merges"]
        letters = byte_letters()
        of_letter = {c: b for b, c in enumerate(letters)}
        self.first = np.array([vocab[c] for c in letters], np.int64)
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.bytes = {i: bytes(of_letter[c] for c in piece) for piece, i in vocab.items()} | {i: t.encode() for t, i in self.special.items()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        key = np.array([(vocab[a] << 32) | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks = key[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.rank_of = dict(zip(key.tolist(), range(len(pairs)), strict=True))
        self.pretokens = regex.compile(PATTERN).findall
        self.at_special = plain.compile("(" + "|".join(map(plain.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.crossing = plain.compile(r" \s")
        self.known: dict[str, tuple[str, int, bytes]] = {}

    def _pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, or NONE."""
        key = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.ranks[at], NONE)

    def _many(self, words: list[bytes], width: int) -> list[list[int]]:
        """Merges words of at most `width` bytes, a row of one array each."""
        n = len(words)
        lengths = np.fromiter(map(len, words), np.int64, n)
        symbols = np.full((n, width + 1), -1, np.int64)
        inside = np.arange(width) < lengths[:, None]
        symbols[:, :width][inside] = self.first[np.frombuffer(b"".join(words), np.uint8)]
        after = np.broadcast_to(np.arange(1, width + 2), (n, width + 1)).copy()
        before = np.broadcast_to(np.arange(-1, width), (n, width + 1)).copy()
        tree = np.full((n, 2 * width), NONE, np.int64)
        ranks = self._pair_ranks(symbols[:, :-1], symbols[:, 1:])
        tree[:, width:] = np.where(ranks < NONE, ranks * width + np.arange(width), NONE)
        for node in range(width - 1, 0, -1):
            tree[:, node] = np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1])
        live = np.flatnonzero(tree[:, 1] < NONE)
        flat_tree, flat, nxt, prev = tree.ravel(), symbols.ravel(), after.ravel(), before.ravel()
        while live.size:
            row, base = live * (width + 1), live * (2 * width)
            rank, i = np.divmod(flat_tree[base + 1], width)
            j = nxt[row + i]
            k = nxt[row + j]
            h = prev[row + i]
            new = self.merged[rank]
            flat[row + i] = new
            flat[row + j] = -1
            nxt[row + i] = k
            prev[row + np.minimum(k, width)] = i
            own = self._pair_ranks(new, flat[row + np.minimum(k, width)])
            flat_tree[base + width + i] = np.where(own < NONE, own * width + i, NONE)
            flat_tree[base + width + j] = NONE
            led = h >= 0
            left = self._pair_ranks(flat[row + h][led], new[led])
            flat_tree[(base + width + h)[led]] = np.where(left < NONE, left * width + h[led], NONE)
            for leaf in (i, j, np.maximum(h, 0)):
                node = (width + leaf) >> 1
                for _ in range(width.bit_length() - 1):
                    child = base + 2 * node
                    flat_tree[base + node] = np.minimum(flat_tree[child], flat_tree[child + 1])
                    node = node >> 1
            live = live[flat_tree[base + 1] < NONE]
        kept = symbols[:, :width]
        ids, ends = kept[kept >= 0].tolist(), np.cumsum((kept >= 0).sum(axis=1)).tolist()
        return [ids[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]

    def _one(self, word: bytes) -> list[int]:
        """Merges one word of any length: n leaves, at most n - 1 merges of three logarithmic updates."""
        n, none, rank_of, merged = len(word), int(NONE), self.rank_of, self.merged
        width = 1 << max(1, (n - 1).bit_length())
        symbols = self.first[np.frombuffer(word, np.uint8)].tolist()
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
        tree = [none] * (2 * width)

        def value(i: int) -> int:
            j = after[i]
            rank = rank_of.get((symbols[i] << 32) | symbols[j]) if j < n else None
            return none if rank is None else rank * width + i

        def put(i: int, x: int) -> None:
            node = width + i
            tree[node] = x
            while node > 1:
                node //= 2
                tree[node] = min(tree[2 * node], tree[2 * node + 1])

        for i in range(n):
            tree[width + i] = value(i)
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])
        while tree[1] < none:
            rank, i = divmod(tree[1], width)
            j = after[i]
            symbols[i], symbols[j] = int(merged[rank]), -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            put(j, none)
            put(i, value(i))
            if before[i] >= 0:
                put(before[i], value(before[i]))
        return [s for s in symbols if s >= 0]

    def merge(self, words: list[bytes]) -> list[list[int]]:
        """The ids of each word."""
        out: list[list[int]] = [[]] * len(words)
        classes: dict[int, list[int]] = {}
        for at, w in enumerate(words):
            classes.setdefault(next((x for x in WIDTHS if len(w) <= x), 0), []).append(at)
        for width, ats in classes.items():
            for lo in range(0, len(ats), ROWS):
                part = ats[lo : lo + ROWS]
                got = self._many([words[a] for a in part], width) if width else [self._one(words[a]) for a in part]
                for a, ids in zip(part, got, strict=True):
                    out[a] = ids
        return out

    def segments(self, text: str) -> list[str]:
        """Parts of a text that are encoded independently of each other.

        A part starts at each space. Where a space is followed by more white space, a pre-token may span two
        parts, and the text stays whole; special strings are parts of their own.
        """
        if self.at_special and any(map(text.__contains__, self.special)):
            return [y for x in self.at_special.split(text) if x for y in ([x] if x in self.special else self.segments(x))]
        if self.crossing.search(text):
            return self.pretokens(text)
        parts = text.split(" ")
        return ([parts[0]] if parts[0] else []) + [" " + x for x in parts[1:]]

    def split(self, segment: str) -> list[str]:
        """The pre-tokens of a segment; letters, and letters with one mark behind them, need no pattern."""
        if segment[:1] == " ":
            if segment[1:].isalpha():
                return [segment]
            if segment[-1] in ".,!?;:" and segment[1:-1].isalpha():
                return [segment[:-1], segment[-1]]
        return [] if segment in self.special else self.pretokens(segment)

    def learn(self, missing: list[str]) -> None:
        """Encodes segments and remembers them."""
        words, spans = [], []
        for segment in missing:
            tokens = self.split(segment)
            spans.append((len(words), len(words) + len(tokens)))
            words += [t.encode() for t in tokens]
        distinct = list(dict.fromkeys(words))
        ids_of = dict(zip(distinct, self.merge(distinct), strict=True))
        for segment, (lo, hi) in zip(missing, spans, strict=True):
            ids = [self.special[segment]] if segment in self.special else [i for w in words[lo:hi] for i in ids_of[w]]
            self.known[segment] = (",".join(map(str, ids)), len(ids), self.decode_bytes(ids))

    def decode_bytes(self, ids) -> bytes:
        """The bytes of some ids."""
        return b"".join(map(self.bytes.__getitem__, ids))

    def decode(self, ids) -> str:
        """The text of some ids; bytes that are no UTF-8 become U+FFFD."""
        return self.decode_bytes(ids).decode("utf-8", "replace")

    def encoded(self, texts: list[str]) -> list[tuple[str, int, bytes]]:
        """For each text its ids as decimals joined by commas, how many they are, and the bytes that they decode to."""
        parts = [self.segments(t) for t in texts]
        if len(self.known) > MEMORY:
            self.known.clear()
        fresh: dict[str, None] = {}
        for p in parts:
            fresh |= dict.fromkeys(x for x in p if x not in self.known)
        self.learn(list(fresh))
        out = []
        for p in parts:
            got = [*map(self.known.__getitem__, p)]
            out.append((",".join([x[0] for x in got]), sum([x[1] for x in got]), b"".join([x[2] for x in got])))
        return out

    def encode(self, text: str) -> list[int]:
        """The ids of one text."""
        joined = self.encoded([text])[0][0]
        return [*map(int, joined.split(","))] if joined else []


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The encoder of this worker."""
    with open(path, encoding="utf-8") as file:
        return Encoder(file.read())


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", batch: int = 500) -> DataFrame:
    """doc_id, ids (comma-joined decimals), n_tokens and the decoded text of every row; one pass, no shuffle."""

    def work(rows: pa.RecordBatch) -> pa.RecordBatch:
        texts, coder = [t or "" for t in rows.column(1).to_pylist()], encoder(path)
        got = [x for lo in range(0, len(texts), batch) for x in coder.encoded(texts[lo : lo + batch])]
        ids, n, back = zip(*got, strict=True)
        decoded = [b.decode("utf-8", "replace") for b in back]
        return pa.record_batch([rows.column(0), pa.array(ids), pa.array(n, pa.int64()), pa.array(decoded)], ["doc_id", "ids", "n_tokens", "decoded"])

    return each_batch(pick(docs, id_col, text_col), work, "doc_id long, ids string, n_tokens long, decoded string")


def digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of the ids and of the decoded text."""
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


