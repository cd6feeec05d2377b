"""Classifiers by held-out accuracy, search by recall, and the pipeline against what its stages promise."""

from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from agenda_engine.llm import ann, quality, toxicity

SMALL = "/root/testdata/sf0.01"


def auc(rows, label):
    up, down = [r.score for r in rows if r[label] == 1], [r.score for r in rows if r[label] == 0]
    return sum((a > b) + 0.5 * (a == b) for a in up for b in down) / (len(up) * len(down))


def test_held_out_rows_follow_their_crc(spark):
    import zlib

    rows = spark.range(200).select("id", quality.held_out("id").alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in rows)


@pytest.mark.parametrize(("judge", "label", "least"), [(quality.judge, "quality", 0.95), (toxicity.judge, "toxic", 0.75)])
def test_held_out_accuracy(spark, judge, label, least):
    docs, labels = spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet")
    scored = judge(docs, labels)
    assert scored.count() == docs.count()
    rows = scored.where("held_out").join(labels, "doc_id").collect()
    assert auc(rows, label) >= least
    assert all(0 <= r.score <= 1 for r in rows)


@pytest.mark.parametrize("judge", [quality.judge, toxicity.judge])
def test_odd_rows_get_scores(spark, judge):
    rows = [(1, None, "x"), (2, "", "x"), (3, "word " * 20000, None), (3, "word " * 20000, None), (None, "no id", None), (4, "fine text " * 30, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 1), (4, None, 5), (2, 1, 0)], "doc_id long, quality int, toxic int")
    got = judge(docs, labels).collect()
    assert len(got) == len(rows)
    assert all(0 <= r.score <= 1 and not math.isnan(r.score) for r in got)


def test_factorisation_uses_the_sum_of_squares_identity():
    rng = np.random.default_rng(0)
    machine = quality.Machine(0.1, rng.normal(size=50), rng.normal(size=(50, 3)))
    index, value = np.array([3, 7, 20]), np.array([0.5, 1.0, 2.0])
    pairs = sum(float(machine.factor[index[a]] @ machine.factor[index[b]]) * value[a] * value[b] for a in range(3) for b in range(a))
    want = 1 / (1 + math.exp(-(0.1 + float(machine.weight[index] @ value) + pairs)))
    assert machine.score([(index, value)])[0] == pytest.approx(want)


def test_training_sees_all_features_of_a_text(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "fit", lambda rows, labels: seen.append((rows, labels)))
    texts = {k: " ".join(f"w{k}x{i}" for i in range(1200)) for k in range(30)}
    docs, labels = spark.createDataFrame(list(texts.items()), "doc_id long, text string"), spark.createDataFrame([(k, k % 2) for k in texts], "doc_id long, quality int")
    quality.train(docs, labels)
    quality.train(docs, labels, values=5000)
    (whole, _), (few, _) = seen
    want = sorted(tuple(quality.features(t)[0]) for k, t in texts.items() if zlib.crc32(str(k).encode()) % 5)
    assert sorted(map(tuple, (i for i, _ in whole))) == want and min(map(len, want)) > 1000
    assert len(few) == 4 and all((a == b).all() for (a, _), (b, _) in zip(few, whole, strict=False))


def test_search_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(600, 16))
    vectors[100:140] = vectors[99]  # ties
    rows = [(i, [float(np.float32(x)) for x in v], 1) for i, v in enumerate(vectors)]
    rows += [(700, None, 1), (720, [0.0] * 16, 1), (740, [float("nan")] + [1.0] * 15, 1), (760, [1.0] * 3, 1), (None, [1.0] * 16, 1), (780, [None] + [1.0] * 15, 1), rows[20]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int").repartition(5)
    got = {}
    for r in ann.nearest(df, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    data = np.array([r[1] for r in rows[:600]], np.float64)
    assert set(got) == set(range(0, 600, 20))
    found = total = 0
    for q, ranked in got.items():
        score = [sum(a * b for a, b in zip(data[q], v, strict=True)) for v in data]
        want = sorted((i for i in range(600) if i != q), key=lambda i: (-score[i], i))[:20]
        assert sorted(ranked) == list(range(1, 21))
        found += len({v for v, _ in ranked.values()} & set(want))
        total += 20
        assert all(s == pytest.approx(score[v], rel=1e-12) for v, s in ranked.values())
    assert found / total >= 0.99


def test_few_or_no_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [2.0, 1.0]), (2, [0.5, 0.5])], "vec_id long, embedding array<float>")
    assert [(r.vec_id, r["rank"]) for r in ann.nearest(df, F.col("vec_id") == 0).orderBy("rank").collect()] == [(1, 1), (2, 2)]
    assert ann.nearest(df.limit(0), F.col("vec_id") == 0).count() == 0


def test_pipeline_keeps_its_promises(spark, tmp_path):
    import corpus_pipeline as pipeline

    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(900)]

    def prose(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    passage = prose(60)
    good = [(k, f"{prose(100)} {passage if k in (3, 8) else ''} {prose(80)}.", "en", "s0", 0) for k in range(60)]
    copy = [(100, good[5][1], "en", "s1", 0), (101, good[6][1], "en", "s1", 0)]
    bad = [(200 + k, " ".join(w.upper() + "!!" for w in prose(60).split()), "en", "s2", 0) for k in range(40)]
    personal = [(300, prose(90) + " write to someone@mail.example.com today", "en", "s3", 0), (301, None, "en", "s3", 0), (302, "", None, None, None)]
    docs = spark.createDataFrame(good + copy + bad + personal, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(k, 1, 0) for k in range(60)] + [(200 + k, 0, 0) for k in range(40)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    at, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in pipeline.STAGES:
        at = stage(spark, at, str(tmp_path))
        at.write.parquet(str(tmp_path / name))
        at = spark.read.parquet(str(tmp_path / name))
        seen[name] = {r.doc_id: r for r in at.collect()}
        assert name == "packing" or at.columns == list(pipeline.COLUMNS)
    assert set(seen["quality"]) >= set(range(60)) and not set(seen["quality"]) & {b[0] for b in bad}
    assert not {100, 101} & set(seen["near_copies"]) and {5, 6} <= set(seen["near_copies"])
    assert passage in seen["repeated_passages"][3].text and passage not in seen["repeated_passages"][8].text
    assert 300 not in seen["personal_data"] or "[EMAIL]" in seen["personal_data"][300].text
    assert set(seen["packing"]) == set(seen["personal_data"])
    assert pipeline.run(spark, str(tmp_path)).count() == at.count()


@pytest.mark.parametrize(("dim", "n"), [(64, 3000), (768, 1500)])
def test_recall_of_the_search(spark, monkeypatch, dim, n):
    monkeypatch.setattr(ann, "CANDIDATES", 700)
    monkeypatch.setattr(ann, "CHUNK", 256)
    rng = np.random.default_rng(dim)
    data = rng.normal(size=(n, dim))
    data[: n // 4] += 2 * data[0]  # a crowded direction
    data = data.astype(np.float32).astype(float)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id long, embedding array<float>").repartition(5)
    got = {}
    for r in ann.nearest(df, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    found = 0
    for q in range(0, n, 20):
        score = data @ data[q]
        score[q] = -np.inf
        want = np.lexsort((np.arange(n), -score))[:20]
        found += len({v for v, _ in got[q].values()} & set(want.tolist()))
        assert all(s == pytest.approx(score[v], rel=1e-9) for v, s in got[q].values())
    assert found / (20 * len(range(0, n, 20))) >= 0.99


@pytest.mark.parametrize(("judge", "label", "kind"), [(quality.judge, "quality", 1), (toxicity.judge, "toxic", 0), (toxicity.judge, "toxic", 1)])
def test_labels_of_one_class_give_their_share(spark, judge, label, kind):
    docs = spark.createDataFrame([(k, f"some words in text {k}") for k in range(30)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, kind, kind) for k in range(30)], "doc_id long, quality int, toxic int")
    scores = [r.score for r in judge(docs, labels).collect()]
    assert len(scores) == 30 and all(abs(s - kind) < 1e-3 for s in scores)


def test_character_models_follow_their_definition(spark):
    """The ratio of a word against a plain recursion over counts, on a small corpus."""
    from collections import Counter

    rng = random.Random(3)
    texts = [" ".join("".join(rng.choice("abcd") for _ in range(rng.randint(1, 7))) for _ in range(12)) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    counts = [Counter(), Counter()]
    for k, t in enumerate(texts[:40]):
        for w in t.split():
            counts[k % 2].update(toxicity.grams(w))
    every = sorted({*counts[0], *counts[1]})
    wanted = spark.createDataFrame([(g,) for g in every], "gram string")
    shared = toxicity.shared_model(toxicity.shared_counts(docs), wanted)

    levels = {toxicity.ORDER: Counter()}
    for t in texts:
        for w in set(t.split()):
            levels[toxicity.ORDER].update(toxicity.grams(w))
    for n in range(toxicity.ORDER - 1, 0, -1):
        levels[n] = Counter()
        for g, c in levels[n + 1].items():
            levels[n][g[1:] if len(g) > n else g] += 1 if len(g) > n else c

    def d(c):
        return toxicity.discount(sum(v == 1 for v in c.values()), sum(v == 2 for v in c.values()))

    def p(g, n):
        if n == 0:
            return 1 / (len(levels[1]) + 1)
        e = g[-n:]
        behind = {x: c for x, c in levels[n].items() if x[:-1] == e[:-1]}
        total = sum(behind.values())
        return (max(levels[n][e] - d(levels[n]), 0) + d(levels[n]) * len(behind) * p(g, n - 1)) / total if total else p(g, n - 1)

    assert all(shared[g] == pytest.approx(p(g, len(g))) for g in every)
    model = toxicity.class_models(every, ([counts[0][g] for g in every], [counts[1][g] for g in every]), shared)

    def own(c, g):
        behind = {x: n for x, n in counts[c].items() if x[:-1] == g[:-1]}
        total = sum(behind.values())
        return (max(counts[c][g] - d(counts[c]), 0) + d(counts[c]) * len(behind) * shared[g]) / total if total else shared[g]

    for w in ("abca", "d", "bbbbbbb"):
        known = [g for g in toxicity.grams(w) if g in shared]
        rest = sum(model.behind.get(g[:-1], 0.0) for g in toxicity.grams(w) if g not in shared)
        assert model.ratio(w) == pytest.approx(sum(math.log(own(1, g) / own(0, g)) for g in known) + rest)
    x = model.differences(["abca d", ""])
    assert x[1] == 0 and x[0] == pytest.approx(sum(math.log1p(toxicity.SHARE * math.expm1(model.ratio(w))) for w in ("abca", "d")) / 2)


def test_pipeline_stages_equal_brute_force(spark, tmp_path):
    """Each stage, and run() whole, against plain versions on a small corpus with copies, passages and personal data."""
    import corpus_pipeline as pipeline
    from test_text_operators import BPE, brute_near_copies
    from tokenizers import Tokenizer

    rng = random.Random(12)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(700)]

    def prose(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    passage, good = prose(40), []
    for k in range(50):
        text = f"{prose(60)} {passage} {prose(60)}." if k % 9 == 4 else f"{prose(150)}."
        good.append((k, text + (f" Mail a{k}@b.example.com or call +1 555 010 9{k:03d}." if k % 10 == 3 else ""), "en", "s0", 0))
    good += [(100 + k, good[k][1].replace(" ", "  ", 1), "en", "s1", 0) for k in range(3)]
    bad = [(200 + k, " ".join(w.upper() + "!!" for w in prose(60).split()), "en", "s2", 0) for k in range(40)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(k, 1, 0) for k in range(50)] + [(200 + k, 0, 0) for k in range(40)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    at, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in pipeline.STAGES:
        stage(spark, at, str(tmp_path)).write.parquet(str(tmp_path / name))
        at = spark.read.parquet(str(tmp_path / name))
        seen[name] = at.collect()
    kept = {r.doc_id: r.text for r in seen["quality"]}
    assert {i for i, *_ in good} <= set(kept) and not set(kept) & {i for i, *_ in bad}
    assert sorted(r.doc_id for r in seen["near_copies"]) == brute_near_copies([(i, t) for i, t in kept.items()])
    first: dict[bytes, int] = {}
    texts = {r.doc_id: r.text.encode() for r in seen["near_copies"]}
    for i in sorted(texts):
        for s in range(len(texts[i]) - 49):
            first.setdefault(texts[i][s : s + 50], i)
    for r in seen["repeated_passages"]:
        data, gone = texts[r.doc_id], set()
        for s in range(len(data) - 49):
            if first[data[s : s + 50]] < r.doc_id:
                gone.update(range(s, s + 50))
        assert r.text == bytes(b for i, b in enumerate(data) if i not in gone).decode("utf-8", "ignore") and r.n_chars == len(r.text)
    clean = {r.doc_id: r.text for r in seen["personal_data"]}
    assert set(clean) == set(texts) and not any("@" in t or "+1 555" in t for t in clean.values()) and sum("[EMAIL]" in t and "[PHONE]" in t for t in clean.values()) == 5
    library = Tokenizer.from_file(BPE)
    want = {}
    for i, t in clean.items():
        ids = library.encode(t, add_special_tokens=False).ids + [2]
        head = len(ids) % 1024 or min(len(ids), 1024)
        for p, (lo, hi) in enumerate([(0, head), *((s, s + 1024) for s in range(head, len(ids), 1024))]):
            want[i, p] = (lo, hi - lo, zlib.crc32(np.array(ids[lo:hi], "<u4").tobytes()))
    told = {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in seen["packing"]}
    assert told == want
    ran = pipeline.run(spark, str(tmp_path)).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in ran} == want


def test_near_copies_of_the_pipeline_go_by_fingerprints_too(spark):
    """Texts within three bits of each other are near copies of op1_simhash; the stage kept both where their Jaccard similarity was under 0.8."""
    import corpus_pipeline as pipeline

    from agenda_engine.llm import copies, simhash

    def pair(seed):
        rng = random.Random(seed)
        base = [f"w{rng.randint(0, 900)}" for _ in range(400)]
        changed = set(rng.sample(range(400), 11))
        return " ".join(base), " ".join(f"z{i}" if i in changed else w for i, w in enumerate(base))

    def linked(a, b):
        bits = (simhash.fingerprint(a) ^ simhash.fingerprint(b)).bit_count()
        return bits <= 3 and not copies.near(copies.shingle_set(a), copies.shingle_set(b))

    a, b = next(p for p in map(pair, range(2000)) if linked(*p))
    far = pair(5000)
    rows = [(7, b, "en", "s", 0), (3, a, "en", "s", 0), (4, far[0], "en", "s", 0), (5, far[0] + " end", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert len(copies.keep_one(docs).collect()) == 3
    assert sorted(r.doc_id for r in pipeline.keep_one_of_near_copies(spark, docs, "").collect()) == [3, 4]
