"""Operators on texts against brute force and the tokenizer libraries, edge cases included."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from agenda_engine.llm import bpe, copies, packing, pii, rules, simhash, suffix, tokens
from agenda_engine.llm.queries import tokenizer

BPE, PIECES = tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, lang string, word string, piece int"
LONG = "palabra larga número " * 3000
TEXTS = [None, "", " ", "a", "Hello  world", "x<|endoftext|>y \n <s> z", "a \n b\n \n c", "ñandú 日本語 😀 ﬁ ▁x ▁ y", "!" * 300, "a" * 2500, LONG, "don't we'll  \t  stop", "one two three four five " * 40]
ODD = [(i, t, "xx", "clash", 9) for i, t in enumerate(TEXTS)] + [(7, TEXTS[7], None, None, None), (None, "no id here", None, None, None), (None, None, None, None, None)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    return sorted((r.asDict() for r in df.collect()), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, str(r)))


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    from agenda_engine.llm import quality, toxicity

    assert tokens.count_tokens(empty, PIECES).count() == 0
    assert bpe.encode(empty, BPE).count() == 0
    assert packing.pack(empty, BPE).count() == 0
    assert simhash.near_duplicates(empty).count() == 0
    assert suffix.deduplicate(empty).count() == 0
    assert rules.ledger(empty).count() == 0
    assert pii.digests(pii.find(empty)).count() == 0
    assert quality.judge(empty, labels).count() == 0
    assert toxicity.judge(empty, labels).count() == 0


def test_token_counts_equal_the_library(odd):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for hot in (3, 150_000):
        got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_bytes, r.n_tokens) for r in tokens.count_tokens(odd, PIECES, hot=hot).collect())
        want = sorted((-1 if i is None else i, len((t or "").encode()), len(model.encode(t or ""))) for i, t, *_ in ODD)
        assert got == want


def test_bpe_equals_the_library_and_goes_back(odd):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BPE)
    got = by_id(bpe.encode(odd, BPE))
    assert len(got) == len(ODD)
    want = {(i, ",".join(map(str, library.encode(t or "", add_special_tokens=False).ids)), t or "") for i, t, *_ in ODD}
    assert {(r["doc_id"], r["ids"], r["decoded"]) for r in got} == want


def test_segment_tree_widths_agree():
    coder = bpe.encoder(BPE)
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdeñ é12") for _ in range(rng.randint(1, 64))).encode() for _ in range(300)]
    assert coder.merge(words) == [coder._one(w) for w in words]


def test_packing_is_whole_and_tight(odd):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BPE)
    ids = {(i, t): library.encode(t or "", add_special_tokens=False).ids + [2] for i, t, *_ in ODD}
    rows = packing.pack(odd, BPE).collect()
    assert sum(r.length for r in rows) == sum(len(ids[i, t]) for i, t, *_ in ODD)
    places: dict[int, list] = {}
    for r in rows:
        options = [v for (i, _), v in ids.items() if i == r.doc_id]
        assert r.ids_crc32 in [zlib.crc32(np.array(v[r.start : r.start + r.length], "<u4").tobytes()) for v in options]
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(places) <= -(-sum(r.length for r in rows) // 1024) + 1


def fewest_sequences(counts, capacity):
    """A number of sequences that no packing can beat: pieces over half a sequence never meet, and leave that much room for the others."""
    w = np.arange(capacity + 1)
    out = 0
    for least in range(capacity // 2 + 1):
        alone, middle = counts[capacity - least + 1 :].sum(), slice(capacity // 2 + 1, capacity - least + 1)
        room = (counts[middle] * (capacity - w[middle])).sum()
        rest = (counts * w)[least : capacity // 2 + 1].sum() - room
        out = max(out, int(alone + counts[middle].sum() + max(0, -(-rest // capacity))))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_plan_keeps_the_histogram(seed):
    rng = np.random.default_rng(seed)
    counts = np.bincount(rng.integers(1, 65, 400), minlength=65)
    filled = packing.plan(counts, 64)
    back = np.zeros(65, int)
    for n, inside in filled:
        assert sum(inside) <= 64
        for v in inside:
            back[v] += n
    assert (back == counts).all()
    assert sum(n for n, _ in filled) <= fewest_sequences(counts, 64) * 1.02 + 1


def brute_fingerprint(text):
    import xxhash

    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_of(fps: list[int], ids: list) -> list:
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    roots = [find(i) for i in range(len(fps))]
    return [min((ids[k] for k in range(len(fps)) if roots[k] == r and ids[k] is not None), default=None) for r in roots]


def test_near_duplicates_equal_brute_force(spark, odd):
    rng = random.Random(5)
    base = [f"w{rng.randint(0, 40)}" for _ in range(120)]
    rows = [(100 + k, " ".join(w if rng.random() > 0.01 * (k % 4) else "Z" for w in base), None, None, None) for k in range(60)] + ODD
    found = simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    fps = [brute_fingerprint(t) for _, t, *_ in rows]
    want = sorted(zip([-1 if r[0] is None else r[0] for r in rows], fps, components_of(fps, [r[0] for r in rows]), strict=True))
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.fp % 2**64, r.component_id) for r in found) == want


def test_crowded_cells_are_dealt_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 4)
    rng = random.Random(2)
    fps = [sum(1 << b for b in rng.sample(range(6), rng.randint(0, 6))) for _ in range(40)] + [rng.getrandbits(64) for _ in range(40)]
    distinct = sorted(set(fps))
    nodes = spark.createDataFrame([(f - 2**64 if f >> 63 else f, n) for n, f in enumerate(distinct)], "fp long, node long")
    from agenda_engine.operators.components import components

    got = {r.node: r.component for r in components(simhash.links(nodes)).collect()}
    want = components_of(distinct, list(range(len(distinct))))
    assert [got.get(n, n) for n in range(len(distinct))] == want


def test_keep_one_keeps_columns_and_one_of_each(spark):
    rows = [(3, "same words in this text", "a", None, 1), (1, "same words in this text", "b", None, 2), (1, "same words in this text", "b", None, 2), (9, "quite another text than that one here", "c", None, 3), (None, "same words in this text", None, None, None)]
    kept = simhash.keep_one(spark.createDataFrame(rows, SCHEMA))
    assert kept.columns == ["doc_id", "text", "lang", "word", "piece"]
    assert sorted(r.doc_id for r in kept.collect()) == [1, 9]


def brute_near_copies(rows):
    """Ids that stay: one of each component of five-word Jaccard 0.8."""
    sets = []
    for _, t, *_ in rows:
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))})
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                label = [label[j] if x == label[i] else x for x in label]
    return sorted(min(rows[k][0] for k in range(len(rows)) if label[k] == x) for x in set(label))


@pytest.mark.parametrize("block", [2, 256])
def test_near_copies_with_changed_words_go(spark, monkeypatch, block):
    monkeypatch.setattr(copies, "BLOCK", block)
    rng = random.Random(11)
    rows = []
    for g in range(8):
        base = [f"w{rng.randint(0, 900)}" for _ in range(200)]
        for k in range(12):
            changed = set(rng.sample(range(200), (0, 1, 2, 3, 4, 5, 6, 8, 10, 14, 20, 40)[k]))
            rows.append((1000 - 12 * g - k, " ".join(f"Z{g}{k}{i}" if i in changed else w for i, w in enumerate(base)), None, None, None))
    rows += [(1, None, "a", None, None), (2, "", "b", None, None), (3, "few words", "c", None, None), (4, " Few  WORDS ", "d", None, None)]
    kept = copies.keep_one(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert kept.columns == ["doc_id", "text", "lang", "word", "piece"]
    got, want = sorted(r.doc_id for r in kept.collect()), brute_near_copies(rows)
    assert got == want and len(want) < len(rows) - 30
    assert len(simhash.keep_one(spark.createDataFrame(rows, SCHEMA)).collect()) > len(want)


def brute_removed(rows, n=50):
    first: dict[bytes, float] = {}
    for i, t in rows:
        key, data = float("inf") if i is None else i, (t or "").encode()
        for s in range(len(data) - n + 1):
            first[data[s : s + n]] = min(key, first.get(data[s : s + n], float("inf")))
    out = []
    for i, t in rows:
        key, data = float("inf") if i is None else i, (t or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - n + 1):
            if first[data[s : s + n]] < key:
                gone[s : s + n] = b"\1" * n
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        out.append((-1 if i is None else i, len(data), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def test_repeated_passages_equal_brute_force(spark):
    rng = random.Random(3)
    parts = ["".join(rng.choice("ab cdé") for _ in range(rng.randint(20, 130))) for _ in range(12)]
    rows = [(k, "".join(rng.choice(parts) for _ in range(rng.randint(0, 6))), None, None, None) for k in range(50)]
    rows += [(60, "z" * 400, None, None, None), (61, "z" * 49, None, None, None), (62, "z" * 50, None, None, None), (63, "ab" * 200, None, None, None), (64, "ba" * 100, None, None, None)]
    rows += [rows[5], (5, "".join(parts[:3]), None, None, None), (None, parts[0] * 2, None, None, None), (None, parts[1] * 3, None, None, None), (70, None, None, None, None)]
    found = suffix.deduplicate(spark.createDataFrame(rows, SCHEMA).repartition(4), carry=("lang",))
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found.collect())
    assert got == brute_removed([(r[0], r[1]) for r in rows])


def test_passages_of_long_texts_are_found_in_slices(spark, monkeypatch):
    rng = random.Random(8)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(150))
    long = "".join(rng.choice("abcdefgh ") for _ in range(3000))
    rows = [(1, long[:500] + passage + long[500:]), (2, "x" + long[200:2600]), (3, passage[:70] + long[900:1000] + "é" * 90 + passage[40:])]
    whole = suffix.sample([r[1].encode() for r in rows])
    monkeypatch.setattr(suffix, "CHUNK", 256)
    parts = [suffix.suffixes(g) for g in suffix.chunks([pa.record_batch([pa.array([i for i, _ in rows]), pa.array([i for i, _ in rows]), pa.array([t for _, t in rows])], ["doc", "row", "text"])])]
    assert sorted((int(d), int(a), int(n)) for p in parts for d, a, n in zip(p["doc"], p["at"], p["name"], strict=True)) == sorted((rows[k][0], int(a), int(n)) for k, a, n in zip(*whole[:3], strict=True))
    for text in (r[1].encode() for r in rows):
        at = suffix.sample([text])[1]
        monkeypatch.setattr(suffix, "CHUNK", 1 << 18)
        want = suffix.windows(text, at, np.full(len(at), 3))
        monkeypatch.setattr(suffix, "CHUNK", 256)
        assert all((a == b).all() for a, b in zip(want, suffix.windows(text, at, np.full(len(at), 3)), strict=True))


def test_windows_meet_by_the_bytes_around_a_suffix(monkeypatch):
    """A window cost 36 bytes in a shuffle, and a suffix has up to 35 of them; now a suffix brings its bytes, and what is found is the same."""
    rng = random.Random(4)
    parts = ["".join(rng.choice("abcd") for _ in range(rng.randint(20, 90))) for _ in range(6)]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 5))).encode() for _ in range(40)] + [b"z" * 130] * 2
    rows, plain = [], []
    for k, t in enumerate(texts):
        at = suffix.sample([t])[1].astype(np.int32)
        sides = np.array([rng.randint(1, 3) for _ in at], np.uint8)
        around, before, after = suffix.around(t, at)
        names = suffix.Hashes(np.frombuffer(t, np.uint8)).of(16)[at] if len(at) else np.zeros(0, np.uint64)
        told = {"name": names, "doc": np.full(len(at), k), "row": np.full(len(at), k), "at": at, "open": sides, "before": before, "after": after, "text": np.frombuffer(around.tobytes(), "V84")}
        rows.append(told)
        plain += [(t[s : s + 50], k, s) for s in suffix.windows(t, at, sides)[0].tolist()]
    first = {}
    for w, k, _ in plain:
        first[w] = min(k, first.get(w, k))
    held = {c: np.concatenate([r[c] for r in rows]) for c in rows[0]}
    assert sum(np.dtype(t).itemsize for t in suffix.AROUND_KINDS.values()) + 84 < 36 * 4
    for most in (1, 4096):
        monkeypatch.setattr(suffix, "AROUND", most)
        found = suffix.met_windows(held)
        assert set(zip(found["row"].tolist(), found["at"].tolist(), strict=True)) == {(k, s) for w, k, s in plain if first[w] < k}


def test_rules_measure_and_ablate(spark, odd):
    got = by_id(rules.ledger(odd))
    assert len(got) == len(ODD)
    for r in got:
        text = next((t for i, t, *_ in ODD if i == r["doc_id"] and rules.measure(t)[0] == r["n_words"]), "")
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        again = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)} if len(windows) < 300 else None
        assert (r["n_words"], r["word_chars"]) == (len(words), sum(map(len, words)))
        assert again is None or r["n_repeat_words"] == len(again)
        assert bool(r["fail_bits"] & 1) == (len(words) < 50)
    table = {r.rule: r for r in rules.ablation(rules.ledger(odd)).collect()}
    assert set(table) == set(rules.POLICIES[rules.CURRENT])
    assert table["too_short"].n_failed == sum(1 for r in got if r["n_words"] < 50)


def test_personal_data_equals_patterns(spark, odd):
    said = [
        "mail a.b@c.example.com_d@e.fr, x@y", "..a@b.c.d..e@f.g", "10.0.0.1 999.1.1.1 1.2.3.4.5 0000255.1.1.1 1.2.3", "4111 1111 1111 1111 and 4111-1111-1111-1112 and 12345678901234567890",
        "+1 (555) 010-9999 +12 345 +123456789012345678", "9" * 5000, "a" * 5000 + "@b.cc", "é +44 20 7946 0958 ü a@b.co",
    ]
    rows = [(200 + k, t, None, None, None) for k, t in enumerate(said)] + ODD
    got = pii.digests(pii.find(spark.createDataFrame(rows, SCHEMA)))

    def luhn(v):
        d = [int(c) for c in v if c.isdigit()]
        return 13 <= len(d) <= 19 and sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(reversed(d))) % 10 == 0

    kinds = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(p) <= 255 for p in v.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", luhn), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 9 <= sum(c.isdigit() for c in v) <= 15),
    )
    want = sorted((-1 if i is None else i, hashlib.sha256(",".join(f"{k}:{m.start()}:{m.end()}" for k, p, ok in kinds for m in re.finditer(p, t or "") if ok(m.group())).encode()).hexdigest()) for i, t, *_ in rows)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.base_sha256) for r in got.collect()) == want


def _disclosed(spark, rows):
    """What pii.disclosing is to find, pair by pair: for each row the terms as text."""
    term = re.compile(r"[^\W\d_]{4,}|(?<![^\W\d_])[A-ZÑ][^\W\d_]{1,2}(?![^\W\d_])")
    found = {r.doc_id: r for r in pii.find(spark.createDataFrame(rows, SCHEMA)).collect()}
    docs = []
    for i, t, *_ in rows:
        text, every = t or "", set()
        for kind in pii.KINDS:
            for s in found[i][kind]:
                v, digits = s.value, re.sub(r"\D", "", s.value)
                every |= {v, {"email": "@" + v.split("@")[-1].lower(), "ip": ".".join(v.split(".")[:3]) + ".", "card": "card " + digits[:6], "phone": "+" + digits[:6]}[kind]}
                text = text[: s.start] + " " * len(v) + text[s.end :]
        docs.append((i, text, every, {w.lower() for w in term.findall(text)}))
    n, k, m, j = len(rows), Counter(), Counter(), {}
    hashes = {r.w: r.h for r in spark.createDataFrame([(w,) for w in {w for d in docs for w in d[3]}], "w string").selectExpr("w", "xxhash64(w) as h").collect()}
    for _, _, every, words in docs:
        k.update(every)
        m.update(words)
        for v in every:
            for w in words:
                j.setdefault((v, w), []).append(min(hashes[x] for x in words) % 64)
    close = {vw: x for vw, x in j.items() if m[vw[1]] <= n * (1 + 1e-9) * (k[vw[0]] / n) ** pii.THRESHOLD and k[vw[0]] < n}
    tested, flagged = sum(map(len, close.values())), set()
    for (v, w), x in close.items():
        e, c = k[v] * m[w] / n, len(x)
        degree = math.log(c * n / (k[v] * m[w])) / math.log(n / k[v])
        unlikely = c > e and c * (1 + math.log(e / c)) - e <= math.log(pii.DOUBT / tested)
        unlike = len(set(x)) >= max(2, 32 * (1 - (63 / 64) ** c))
        spelled = v.find("@") > 0 and w in re.split(r"[\W\d_]+", v.split("@")[0].lower())
        if degree >= pii.THRESHOLD and (spelled or unlikely and unlike):
            flagged.add((v, w))
    want = {i: [x for x in term.findall(text) if any((v, x.lower()) in flagged for v in every)] for i, text, every, _ in docs}
    text = {i: t or "" for i, t, *_ in rows}
    assert {i: [text[i][s.start : s.end] for s in r.terms] for i, r in found.items()} == want
    return want


def _babble(seed, size=40, many=4000):
    """A text of words that other texts use too, the lower numbers more often."""
    rng = random.Random(seed)
    return " ".join("w" + "".join(chr(97 + int(c)) for c in f"{int(many * rng.random() ** 3):05d}") for _ in range(size))


def test_identities_are_found_over_unlike_documents(spark):
    """Of the documents of an identity all are caught, by name, by a short name and by a nickname; of other words hardly any."""
    rows = [(k, _babble(k), None, None, None) for k in range(600)]
    for who, (name, value) in enumerate([("Quixoteman Ng", "boss@corp.example.com"), ("Zurbriggen Al", "+44 20 7946 0958"), ("Ostrovskaya Wu", "10.77.3.9")]):
        for k in range(who * 50, who * 50 + 5):
            rows[k] = (k, f"{_babble(k)} {name} {_babble(k + 7000, 9)} {value} {_babble(k + 9000, 9)}", None, None, None)
    for k in range(200, 230):  # values of one document tell nothing
        rows[k] = (k, f"{_babble(k)} once{k}@mail{k}.example.org", None, None, None)
    rows.append((999, None, None, None, None))
    want = _disclosed(spark, rows)
    for who, name in enumerate(["Quixoteman Ng", "Zurbriggen Al", "Ostrovskaya Wu"]):
        assert all(set(name.split()) <= set(want[k]) for k in range(who * 50, who * 50 + 5))
    names, words = {"Quixoteman", "Ng", "Zurbriggen", "Al", "Ostrovskaya", "Wu"}, sum(len((t or "").split()) for i, t, *_ in rows if want[i] or 200 <= i < 230)
    assert sum(t not in names for w in want.values() for t in w) < 0.01 * words


def test_an_organisation_is_found_over_the_addresses_of_its_domain(spark):
    rows = [(k, _babble(k), None, None, None) for k in range(600)]
    for k in range(6):
        rows[k] = (k, f"{_babble(k)} person{k}@acme.example.net {_babble(k + 9000, 9)} Acmeworks", None, None, None)
    want = _disclosed(spark, rows)
    assert all("Acmeworks" in want[k] for k in range(6))


def test_copies_are_one_witness(spark):
    """A text that is copied, with a word changed or none, does not disclose its own rare words."""
    said = f"{_babble(1, 60)} Quixoteman wrote {_babble(2, 60)} rare@corp.example.com"
    rows = [(k, _babble(100 + k), None, None, None) for k in range(500)]
    for k in range(40):
        words = said.split()
        if k % 2:
            words[(k * 7) % 100] = f"changed{'abcdefghij'[k % 10]}"
        rows[k] = (k, " ".join(words), None, None, None)
    want = _disclosed(spark, rows)
    assert not any(want.values())


def test_a_name_that_the_address_spells_is_found_in_one_document(spark):
    rows = [(k, f"common words and thing about other filler {k}", None, None, None) for k in range(400)]
    rows[7] = (7, "Ana Zurbriggen ñ 10.0.0.1 " + "common words about " * 20 + "ana.zurbriggen@x.example.org+44 20 7946 0958 " + "about other thing " * 20 + "zurbriggeN", None, None, None)
    want = _disclosed(spark, rows)
    assert want.pop(7) == ["Ana", "Zurbriggen", "zurbriggeN"] and not any(want.values())
    text, docs = rows[7][1], spark.createDataFrame([*rows, (999, None, "l", "w", 5)], SCHEMA)
    clean = {r.doc_id: r for r in pii.sanitise(docs).collect()}
    assert clean[7].text.startswith("[TERM] [TERM] ñ [IP] common") and clean[7].text.endswith("thing [TERM]") and "[EMAIL][PHONE]" in clean[7].text
    assert clean[999].text is None and clean[999].piece == 5 and clean[60].text == rows[60][1] and len(text) > 0


def test_packed_ids_are_the_documents(odd):
    row = packing.pack(odd.where("doc_id = 4"), BPE, keep_ids=True).first()
    assert bpe.encoder(BPE).decode([i for i in row.ids if i != 2]) == "Hello  world"


def test_no_python_in_the_native_plan(odd):
    plan = pii.find(odd)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_queries_read_whole_tables(spark):
    from agenda_engine.llm.queries import QUERIES

    assert [n for n in QUERIES if n.startswith("op")] and len(QUERIES) == 13


def test_many_matches_in_one_text_cost_about_their_number(spark):
    text = " ".join(f"é a{i}@b{i % 97}.example.com" for i in range(3000))
    docs = spark.createDataFrame([(1, text, None, None, None), (2, text + "!", None, None, None)], SCHEMA)
    found = {r.doc_id: r for r in pii.find(docs).collect()}
    want = [(m.start(), m.end(), m.group()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    assert len(want) == 3000 > pii.BLOCK and all([tuple(s) for s in found[i].email] == want for i in (1, 2))
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert clean[2] == " ".join(["é [EMAIL]"] * 3000) + "!"


def test_patterns_place_most_pieces():
    rng = np.random.default_rng(4)
    counts = np.bincount(np.clip(rng.lognormal(5.5, 1.1, 20_000).astype(int), 1, 1024), minlength=1025)
    fitted, rest = packing.plans(counts, 1024)
    back = np.zeros(1025, int)
    for n, inside in fitted + rest:
        assert sum(inside) <= 1024
        np.add.at(back, inside, n)
    assert (back == counts).all() and all(sum(inside) == 1024 for _, inside in fitted)
    assert sum(n * len(inside) for n, inside in fitted) > 0.5 * counts.sum()
    assert sum(n for n, _ in fitted + rest) <= fewest_sequences(counts, 1024) + 1


def test_fit_is_the_least_squares_optimum():
    rng = np.random.default_rng(6)
    counts = np.bincount(rng.integers(1, 25, 300), minlength=25)
    ways = packing.patterns(24, np.flatnonzero(counts))
    x = packing.fit(counts, ways)
    matrix = np.zeros((25, len(ways)))
    for j, way in enumerate(ways):
        np.add.at(matrix[:, j], way[way > 0], 1)
    slope = matrix.T @ (matrix @ x - np.where(np.arange(25) > 0, counts, 0))
    assert (x >= 0).all() and slope.min() > -0.1 and np.abs(slope[x > 0]).max() < 0.1  # no descent is left


def test_hot_pretokens_are_cut_by_a_step(spark):
    rows = [(f"t{i}", 1 if i > 20 else 1000 - i, 1) for i in range(500)]
    known = spark.createDataFrame(rows, "key string, n_docs long, n_pieces long")
    assert {r.key for r in tokens.often(known, 100).collect()} == {f"t{i}" for i in range(21)}
    assert tokens.often(known, 5).count() == 0 and tokens.often(known, 500).count() == 500
