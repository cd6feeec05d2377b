"""Lexicons against one search for each name."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from agenda_engine.functions.trie import Lexicon, trie
from agenda_engine.operators import places


def plain(pairs, text):
    return next((v for n, v in pairs if re.search(rf"(?<!\w){re.escape(n)}(?!\w)", text)), None)


@pytest.mark.parametrize("order", ["listed", "longest"])
def test_lexicon_equals_a_search_for_each_name(spark, order):
    rng = random.Random(2)
    parts = ["la", "paz", "santa", "cruz", "av", "ñu", "x1", "y_z", "de"]
    names = list({rng.choice(["", "el "]) + rng.choice([" ", ". ", "-"]).join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(60)})
    pairs = [(n, f"v{i % 25}") for i, n in enumerate(names)]
    pairs = sorted(pairs, key=lambda p: -len(p[0])) if order == "longest" else pairs
    texts = ["".join(rng.choice([*parts, "el", "zz", " ", " ", " ", ". ", "-", "_"]) for _ in range(rng.randint(0, 14))) for _ in range(400)] + ["", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", Lexicon(pairs).first(F.col("t")).alias("v")).collect()
    assert [(r.t, r.v) for r in rows] == [(t, plain(pairs, t or "")) for t in texts]
    assert sum(r.v is not None for r in rows) > 50


def test_known_places_equal_a_search_for_each_alias(spark):
    rng = random.Random(5)
    every = [a for aliases in places.DEPARTMENT_ALIASES.values() for a in aliases] + [a for aliases, _, _ in places.VENUES.values() for a in aliases]
    texts = [" ".join(rng.choice([*every, "hoy", "gran", "en"]) for _ in range(3)) + rng.choice(["", "x", ".", " oruro"]) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    listed = {k: v for k, v in (("department", [(a, d) for d, al in places.DEPARTMENT_ALIASES.items() for a in al]), ("venue", sorted([(a, n) for n, (al, _, _) in places.VENUES.items() for a in al], key=lambda p: -len(p[0]))))}
    for kind, pairs in listed.items():
        got = df.select("t", places.lexicons()[kind].first(F.col("t")).alias("v")).collect()
        assert [r.v for r in got] == [plain(pairs, t) for t in texts]


def test_ten_thousand_names_do_not_grow_the_plan(spark):
    df = spark.createDataFrame([("el nombre 7777 de hoy",)], "t string")

    def told(n):
        found = df.select(Lexicon([(f"nombre {i}", str(i)) for i in range(n)]).first(F.col("t")).alias("v"))
        nodes = found._jdf.queryExecution().analyzed().expressions()
        return found, nodes.size(), len(re.sub(r'"(?:[^"\\]|\\.)*"|\{.*\}', "", found._jdf.queryExecution().executedPlan().treeString()).splitlines())

    few, many = told(10), told(10_000)
    assert few[1:] == many[1:] and many[0].first().v == "7777"
    assert len(trie(["teatro uno", "teatro dos", "teatro"])) < 60
    with pytest.raises(ValueError, match="word character"):
        Lexicon([("av.", "x")])
