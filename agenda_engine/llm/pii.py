"""Personal data, and terms that give it away, with DataFrame functions only.

Base kinds are matched by patterns and checks. Around them works information-theoretic sanitisation. A protected entity v
is a value, or what values have in common: the domain of an address, a network, the first digits of a card or a number.
For v and a term t, the corpus gives how many documents hold v (k), hold t outside of base values (m) and hold
both (j) among N. t discloses v to the degree PMI(v; t) / IC(v) = ln(jN / km) / ln(N / k): 1 if t is
seen with v alone, 0 if they are independent. A term becomes a span of kind "term" wherever it
stands in a document that holds v if

* the degree reaches the threshold,
* j is no chance: j or more of independent v and t have a probability of at most exp(j - e + j ln(e / j)) with e = km / N
  (Chernoff), and the expected number of such pairs by chance, over all pairs of the corpus, stays within DOUBT;
* unlike documents say so: copies of one text, with few changes or none, are one witness. A document's witness is one of 64 bits, from the
  smallest hash of its terms, which near copies mostly share; at least two bits, and half of what j unlike documents set, have to be there;
* or, in place of the last two, the term is spelled out in the address (ana.ruiz@... and Ruiz).

Sanitising removes base values for the name of their kind and generalises such terms. A term is a word of four letters, or a capitalised
one of two.

The patterns run as they are defined, leftmost and non-overlapping, but written so that a long run is tried
once: runs are possessive, and a match may only start where a run starts or where the match before ended.

Defined results: a null or empty text has no spans; texts are searched whole; copies count as documents;
repeated rows keep a row each; an empty table gives an empty result; further columns stay as
they are in sanitise() and are ignored in find().
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agenda_engine.llm.common import cut, scratch

LOCAL, LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
PATTERNS = {
    "email": f"(?:(?<!{LOCAL})|\\G){LOCAL}++@{LABEL}++(?:\\.{LABEL}++)++",
    "ip": "(?<![0-9])[0-9]++(?:\\.[0-9]++){3}",
    "card": "[0-9](?:[\\x20-]?[0-9])++",
    "phone": "\\+[0-9][\\x20().0-9-]+[0-9]",
}
#: What a text must hold for a kind to be worth a search.
NEEDS = {"email": "@", "ip": ".", "phone": "+"}
CHECKS = {
    "email": "true",
    "ip": "forall(split(s.value, '[.]'), p -> length(ltrim('0', p)) <= 3 and coalesce(try_cast(ltrim('0', p) as int), 0) <= 255)",
    "card": "case when length(translate(s.value, ' -', '')) between 13 and 19 then aggregate(sequence(1, length(translate(s.value, ' -', ''))), 0, "
    "(a, i) -> a + case when i % 2 = 0 then 2 * (ascii(substr(translate(s.value, ' -', ''), -i, 1)) - 48) - case when substr(translate(s.value, ' -', ''), -i, 1) > '4' then 9 else 0 end "
    "else ascii(substr(translate(s.value, ' -', ''), -i, 1)) - 48 end) % 10 = 0 else false end",
    "phone": "length(translate(s.value, '+ ().-', '')) between 9 and 15",
}
KINDS = tuple(PATTERNS)
TERM = "\\p{L}{4,}|(?<!\\p{L})\\p{Lu}\\p{L}{1,2}(?!\\p{L})"
#: Least share of an entity's information; largest expected number of pairs by chance in a corpus; bits of witnesses.
THRESHOLD, DOUBT, WITNESSES = 0.8, 0.05, 64
#: What the values of a kind have in common with others.
COMMON = {
    "email": "concat('@', lower(substring_index(s.value, '@', -1)))",
    "ip": "concat(substring_index(s.value, '.', 3), '.')",
    "card": "concat('card ', substr(translate(s.value, ' -', ''), 1, 6))",
    "phone": "concat('+', substr(translate(s.value, '+ ().-', ''), 1, 6))",
}
#: Elements that an array grows by at once, at least.
BLOCK = 256
SPAN = "array<struct<start:int,end:int,value:string>>"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def gathered(items: Column, measure: Callable[[Column], Column], combine: Callable[[Column, Column], Column], step: Callable[[Column, Column], Column], none: Column) -> Column:
    """What a fold over items (a lambda's variable) puts out: its state is a place (at) and a growing array (out).

    An array is copied for each element that it grows by, so items go by blocks, about as many as a block has items. The
    place at the start of a block is what combine() makes of the measures of all items before it, starting from 0.
    """
    size = F.greatest(F.lit(BLOCK), F.ceil(F.sqrt(F.size(items)))).cast("int")
    count = F.ceil(F.size(items) / size).cast("int")
    blocks = F.slice(F.sequence(F.lit(0), count), F.lit(1), count)

    def block(i: Column) -> Column:
        return F.slice(items, i * size + 1, size)

    def after(acc: Column, m: Column) -> Column:
        return F.struct(combine(acc["at"], m).alias("at"), F.array_append(acc["out"], acc["at"]).alias("out"))

    sums = F.transform(blocks, lambda i: F.aggregate(block(i), F.lit(0), lambda a, x: combine(a, measure(x))))
    starts = F.aggregate(sums, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")), after)["out"]
    return bound(starts, lambda at: F.flatten(F.transform(blocks, lambda i: F.aggregate(block(i), F.struct(F.get(at, i).alias("at"), none.alias("out")), step)["out"])))


def spans(text: Column, pattern: str, wanted: Callable[[Column], Column] | None = None) -> Column:
    """The matches of a pattern, or those of wanted values, as structs of start, end (code points, end exclusive) and value."""
    none = F.from_json(F.lit("[]"), SPAN)

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + F.length(x["value"])
        more = F.array_append(acc["out"], F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value")))
        return F.struct(end.alias("at"), (F.when(wanted(x["value"]), more).otherwise(acc["out"]) if wanted else more).alias("out"))

    def placed(found: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
        pairs = F.zip_with(gaps, found, lambda gap, value: F.struct(F.length(gap).alias("gap"), value.alias("value")))
        whole = bound(pairs, lambda p: gathered(p, lambda x: x["gap"] + F.length(x["value"]), lambda a, b: a + b, add, none))
        return F.when(F.size(found) > 0, whole).otherwise(none)

    return bound(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)


def replaced(text: Column, spots: Column, name: Callable[[Column, Column], Column]) -> Column:
    """The text with name(spot, first code point not yet replaced) in place of each of some sorted spots of start and end."""

    def put(wide: Column, items: Column) -> Column:
        def part(start: Column, end: Column) -> Column:  # four bytes a code point, so that no part has to be looked for from the start
            return F.decode(F.substring(wide, start * 4 + 1, (end - start) * 4), "UTF-32")

        def add(acc: Column, s: Column) -> Column:
            gap = F.when(s["start"] > acc["at"], part(acc["at"], s["start"])).otherwise("")
            return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.array_append(acc["out"], F.concat(gap, name(s, acc["at"]))).alias("out"))

        pieces = gathered(items, lambda s: s["end"], F.greatest, add, F.array().cast("array<string>"))
        return F.concat(F.array_join(pieces, ""), part(F.aggregate(items, F.lit(0), lambda a, s: F.greatest(a, s["end"])), (F.octet_length(wide) / 4).cast("int")))

    return F.when(F.size(spots) > 0, bound(F.encode(text, "UTF-32"), lambda wide: bound(spots, lambda items: put(wide, items)))).otherwise(text)


def base(text: Column) -> list[Column]:
    """The spans of each base kind, as columns named after the kinds."""
    out = []
    for kind, pattern in PATTERNS.items():
        found = spans(text, pattern)
        if kind in NEEDS:
            found = F.when(F.contains(text, F.lit(NEEDS[kind])), found).otherwise(F.from_json(F.lit("[]"), SPAN))
        out.append(found.alias(kind))
    return out


def _checked(kind: str) -> Column:
    return F.expr(f"filter({kind}, s -> {CHECKS[kind]})").alias(kind)


def _base_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text, text_hash and the checked spans of each kind."""
    rows = docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    rows = rows.select("doc_id", "text", F.xxhash64("text").alias("text_hash"), *base(F.col("text")))
    return rows.select("doc_id", "text", "text_hash", *map(_checked, KINDS))


def _blanked(text: Column) -> Column:
    """The text with every base span as blanks, so that places stay."""
    every = F.sort_array(F.concat(*(F.transform(k, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))) for k in KINDS)))
    return replaced(text, every, lambda s, at: F.repeat(F.lit(" "), F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], at))))


def _words(text: Column) -> Column:
    """The distinct terms of a text, in lower case."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), F.lower))


def _witness(words: Column) -> Column:
    """One of the bits of a long, from the smallest hash of some words; null without words."""
    place = F.pmod(F.array_min(F.transform(words, lambda w: F.xxhash64(w))), F.lit(WITNESSES)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)


def disclosing(docs: DataFrame, rows: DataFrame, text_col: str = "text", threshold: float = THRESHOLD, doubt: float = DOUBT) -> DataFrame:
    """(doc_id, text_hash, terms): the spans of disclosing terms of each document that has any.

    Counts cover all documents, with map-side combine; witnesses are bits, so a hot entity combines as well. A pair of an entity and a term
    of its document is formed only if m lets it reach the threshold: j is at most k, so m is at most N (k / N) ** threshold.
    """
    key = ["doc_id", "text_hash"]
    held = rows.where(" or ".join(f"size({k}) > 0" for k in KINDS)).withColumn("blanked", _blanked(F.col("text")))
    # blanks may part a word from what a value took of it, which makes words of its own
    told = bound(F.struct(_words(F.col("text")).alias("before"), _words(F.col("blanked")).alias("after")), lambda w: F.struct(F.array_except(w["before"], w["after"]).alias("lost"), F.array_except(w["after"], w["before"]).alias("won"), _witness(w["after"]).alias("witness")))
    held = cut(held.select(*key, *KINDS, "blanked", told.alias("told")).select(*key, *KINDS, "blanked", "told.*"))
    exact = (F.expr(f"transform({k}, s -> s.value)") for k in KINDS)
    common = (F.expr(f"transform({k}, s -> {COMMON[k]})") for k in KINDS)
    every = F.array_distinct(F.concat(*exact, *common))
    values = cut(held.select(*key, F.explode(every).alias("value")).groupBy(*key, "value").agg(F.count(F.lit(1)).alias("rows")))
    k = cut(values.groupBy("value").agg(F.sum("rows").alias("k")))
    total, most = rows.count(), k.agg(F.coalesce(F.max("k"), F.lit(0))).first()[0]

    def frequent(k: Column) -> Column:
        return F.lit(total * (1 + 1e-9)) * F.pow(k / F.lit(float(max(total, 1))), F.lit(threshold))

    seen = docs.select(F.explode(_words(docs[text_col])).alias("term"), F.lit(1).alias("n"))
    lost, won = (held.select(F.explode(c).alias("term"), F.lit(n).alias("n")) for c, n in (("lost", -1), ("won", 1)))
    m = seen.unionAll(lost).unionAll(won).groupBy("term").agg(F.sum("n").alias("m")).where((F.col("m") > 0) & (F.col("m") <= frequent(F.lit(most))))
    said = held.select(*key, "witness", "blanked").dropDuplicates(key)
    terms = said.select(*key, "witness", F.explode(_words(F.col("blanked"))).alias("term")).join(m, "term").withColumnsRenamed({"doc_id": "of_doc", "text_hash": "of_text"})
    same = F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("text_hash") == F.col("of_text"))
    entities = values.join(k, "value").where(F.lit(total) > F.col("k"))
    pairs = cut(entities.join(terms, same & (F.col("m") <= frequent(F.col("k")))).select(*key, "rows", "value", "k", "term", "m", "witness"))
    joint = pairs.groupBy("value", "term").agg(F.sum("rows").alias("j"), F.max("k").alias("k"), F.max("m").alias("m"), F.bit_count(F.bit_or("witness")).alias("witnesses"))
    j, n = F.col("j"), F.lit(float(total))
    degree = F.log(j * n / (F.col("k") * F.col("m"))) / F.log(n / F.col("k"))
    chance = F.col("k") * F.col("m") / n
    unlikely = j * (1 + F.log(chance / j)) - chance <= math.log(doubt / max(1, pairs.count()))
    unlike = F.col("witnesses") >= F.greatest(F.lit(2.0), F.lit(WITNESSES / 2) * (1 - F.pow(F.lit(1 - 1 / WITNESSES), j)))
    spelled = F.expr("position('@', value) > 1 and array_contains(split(lower(substring_index(value, '@', 1)), '[^\\\\p{L}]+'), term)")
    flagged = joint.where((degree >= threshold) & (spelled | (j > chance) & unlikely & unlike)).select("value", "term")
    hits = pairs.join(flagged, ["value", "term"]).groupBy(*key).agg(F.collect_set("term").alias("flagged")).withColumnsRenamed({"doc_id": "of_doc", "text_hash": "of_text"})
    found = held.join(hits, same)
    found = found.select(*key, spans(F.col("blanked"), TERM, lambda value: F.array_contains("flagged", F.lower(value))).alias("all"))
    return found.select(*key, F.transform("all", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias("terms")).dropDuplicates(key)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, doubt: float = DOUBT) -> DataFrame:
    """doc_id, the spans of each base kind and those of disclosing terms, for every input row."""
    rows = cut(_base_rows(docs, id_col, text_col).withColumn("text", F.when(F.greatest(*(F.size(k) for k in KINDS)) > 0, F.col("text"))))
    with scratch(docs.sparkSession) as keep:
        extra = keep(disclosing(docs, rows, text_col, threshold, doubt)).withColumnsRenamed({"doc_id": "of_doc", "text_hash": "of_text"})
    joined = rows.drop("text").join(extra, F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("text_hash") == F.col("of_text")), "left")
    return joined.select("doc_id", *KINDS, F.coalesce("terms", F.from_json(F.lit("[]"), "array<struct<start:int,end:int>>")).alias("terms"))


def told(kinds: tuple[str, ...]) -> Column:
    """kind:start:end of the spans of some columns, joined by commas."""
    names = {k: "term" if k == "terms" else k for k in kinds}
    return F.array_join(F.concat(*(F.expr(f"transform({k}, s -> concat_ws(':', '{names[k]}', string(s.start), string(s.end)))") for k in kinds)), ",")


def digests(found: DataFrame) -> DataFrame:
    """Counts, the digest of the base spans, and all spans."""
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(told(KINDS), 256).alias("base_sha256"), told((*KINDS, "terms")).alias("spans"))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, doubt: float = DOUBT) -> DataFrame:
    """The input with every base value replaced by [KIND] and every disclosing term by [TERM]; a null text stays null.

    Overlapping spans are replaced together, by the name of the one that starts first. Other columns stay.
    """
    found = cut(_base_rows(docs, id_col, text_col).withColumn("text", F.when(F.greatest(*(F.size(k) for k in KINDS)) > 0, F.col("text"))))
    with scratch(docs.sparkSession) as keep:
        extra = keep(disclosing(docs, found, text_col, threshold, doubt)).withColumnsRenamed({"doc_id": "of_doc", "text_hash": "of_text"})
    base_spans = F.concat(*(F.expr(f"transform({k}, s -> struct(s.start as start, s.end as end, '[{k.upper()}]' as name))") for k in KINDS))
    known = found.where("text is not null").select("doc_id", "text_hash", base_spans.alias("base_spans")).dropDuplicates(["doc_id", "text_hash"])
    joined = known.join(extra, F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("text_hash") == F.col("of_text")), "left")
    term_spans = F.transform("terms", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit("[TERM]").alias("name")))
    spots = joined.select(F.col("doc_id").alias("spot_doc"), F.col("text_hash").alias("spot_text"), F.sort_array(F.concat("base_spans", F.coalesce(term_spans, F.array()))).alias("spots"))
    text = docs[text_col]
    met = docs.join(spots, docs[id_col].eqNullSafe(F.col("spot_doc")) & (F.xxhash64(F.coalesce(text, F.lit(""))) == F.col("spot_text")), "left")
    clean = replaced(text, F.col("spots"), lambda s, at: F.when(s["start"] < at, "").otherwise(s["name"]))
    return met.withColumn("clean_text", F.when(F.col("spots").isNull() | text.isNull(), text).otherwise(clean)).drop("spot_doc", "spot_text", "spots").drop(text).withColumnRenamed("clean_text", text_col).select(*docs.columns)
