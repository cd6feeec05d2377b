"""Letters with several marks against the standard form."""

from __future__ import annotations

import random
import unicodedata

from pyspark.sql import functions as F

from agenda_engine.functions.text import compatible


def test_several_marks_equal_the_standard_form(spark):
    rng = random.Random(6)
    marks = "̧̨̛̣̱́̀̂̈̄̊̃̈́ͅ⃝़゙ְ"
    texts = ["".join(rng.choice("aeiouAnNsScçüộΩαﬁか") + "".join(rng.choice(marks) for _ in range(rng.randint(0, 4))) for _ in range(rng.randint(1, 6))) for _ in range(400)]
    texts += ["ą́̄", "́a", "ộx", "Ǻ ﬁñ", "plain"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", compatible(F.col("t")).alias("c")).collect()
    wrong = [(ascii(r.t), ascii(r.c), ascii(unicodedata.normalize("NFKC", r.t))) for r in got if r.c != unicodedata.normalize("NFKC", r.t)]
    assert wrong == []
