"""Quality rules as a bitmask ledger.

Every rule is evaluated once for every document. The ledger keeps the measurements and one bit for each rule
that the document fails; a policy is a versioned set of rules, applied as a mask, and an ablation asks what
each rule adds to a policy, all without reading a text again.

Defined results: a null text has no words and fails the rule on length; an empty table gives an empty ledger;
repeated rows give repeated ledger rows; any further columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agenda_engine.llm.common import SPACES, each_batch, pick

SYMBOLS = "#*$%&|<>"
CAPITAL = re.compile("[A-Z]")
MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_upper long, n_shouts long"


@dataclass(frozen=True)
class Rule:
    """A rule by its bit, and when a document fails it. Integers only, so that every engine agrees."""

    bit: int
    name: str
    fails: str


#: The order is part of the format: bit i of a ledger is rule i. New rules go to the end.
RULES = (
    Rule(0, "too_short", "n_words < 50"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > 3 * n_words"),
    Rule(3, "word_length", "word_chars < 2 * n_words or word_chars > 15 * n_words"),
    Rule(4, "repeated_lines", "10 * n_dup_lines > 6 * n_lines"),
    Rule(5, "capitals", "10 * n_upper > 6 * word_chars"),
    Rule(6, "shouting", "10 * n_shouts > 3 * n_words"),
)
BASE = ("too_short", "repeated_windows")
POLICIES = {
    "base": BASE,
    "v1": (*BASE, "symbols", "word_length", "repeated_lines"),
    "v2": (*BASE, "symbols", "word_length", "repeated_lines", "capitals", "shouting"),
}
CURRENT = "v2"


def measure(text: str | None) -> tuple[int, ...]:
    """The measurements of one text, in the order of MEASURES."""
    text = text or ""
    words = text.encode().split()
    n = len(words)
    seen = Counter(zip(words, words[1:], words[2:], strict=False))
    repeated = last = 0
    if len(seen) < n - 2:
        last = -1
        for i, window in enumerate(zip(words, words[1:], words[2:], strict=False)):
            if seen[window] > 1:
                repeated += i + 2 - max(last, i - 1)
                last = i + 2
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return (
        n,
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated,
        len(lines),
        len(CAPITAL.findall(text)),
        text.count("!"),
    )


def mask(names: tuple[str, ...]) -> int:
    """The bits of some rules."""
    return sum(1 << r.bit for r in RULES if r.name in names)


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, all measurements and fail_bits, a row for every input row; one pass, no shuffle."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = list(zip(*map(measure, batch.column(1).to_pylist()), strict=True))
        return pa.record_batch([batch.column(0), *(pa.array(c, pa.int64()) for c in columns)], names)

    names = ["doc_id", *(x.split()[0] for x in MEASURES.split(", "))]
    measured = each_batch(pick(docs, id_col, text_col), work, f"doc_id long, {MEASURES}")
    bits = sum((F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(F.lit(0)) for r in RULES), F.lit(0))
    return measured.withColumn("fail_bits", bits.cast("long"))


def fails(policy: str, bits: str | Column = "fail_bits") -> Column:
    """True where a ledger row fails any rule of the policy."""
    return (F.col(bits) if isinstance(bits, str) else bits).bitwiseAND(F.lit(mask(POLICIES[policy]))) != 0


def ablation(rows: DataFrame, policy: str = CURRENT) -> DataFrame:
    """For each rule of a policy: documents that fail it, that fail it alone (so return without it), and the bits failed beside it.

    One pass: ledger rows collapse to at most 2 ** len(RULES) bit patterns before anything else happens.
    """
    whole = mask(POLICIES[policy])
    patterns = rows.groupBy(F.col("fail_bits").bitwiseAND(F.lit(whole)).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    names = F.explode(F.array(*(F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit")) for r in RULES if r.name in POLICIES[policy])))
    hit = patterns.select("bits", "n", names.alias("r")).select("bits", "n", "r.*")
    failed = F.col("bits").bitwiseAND(F.col("bit")) != 0
    return hit.groupBy("rule").agg(
        F.coalesce(F.sum(F.when(failed, F.col("n"))), F.lit(0)).alias("n_failed"),
        F.coalesce(F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n"))), F.lit(0)).alias("n_only"),
        F.coalesce(F.bit_or(F.when(failed, F.col("bits").bitwiseXOR(F.col("bit")))), F.lit(0)).alias("beside_bits"),
    )
