"""Text normalisation, token sets and ordered lists as column expressions."""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F


#: Ranges of characters under one test, and parts of a table of characters.
GUARDED, DEALT = 12, 512


@lru_cache(maxsize=1)
def _folding() -> tuple[str, str, str]:
    """translate() arguments that decompose: characters with a one-character base, their bases, and combining marks."""
    source, target, marks = [], [], []
    for point in range(0x80, sys.maxunicode + 1):
        char = chr(point)
        if unicodedata.combining(char):
            marks.append(char)
            continue
        if 0xAC00 <= point <= 0xD7A3 or 0xD800 <= point <= 0xDFFF:  # syllables decompose into several letters
            continue
        base = "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c))
        if base != char and len(base) == 1:
            source.append(char)
            target.append(base)
    return "".join(source), "".join(target), "".join(marks)


@lru_cache(maxsize=1)
def _spelled() -> dict[str, str]:
    """Characters that decompose into several letters, with these letters; syllables of Hangul stay."""
    out = {}
    for point in range(0x80, sys.maxunicode + 1):
        if not (0xAC00 <= point <= 0xD7A3 or 0xD800 <= point <= 0xDFFF) and not unicodedata.combining(chr(point)):
            base = "".join(c for c in unicodedata.normalize("NFKD", chr(point)) if not unicodedata.combining(c))
            if len(base) != 1:
                out[chr(point)] = base
    return out


@lru_cache(maxsize=1)
def _composed() -> tuple[str, str, dict[str, str]]:
    """translate() arguments of the characters that stand for one other, and what other characters, or letters with marks, stand for."""
    source, target, several = [], [], {}
    for point in range(0x80, sys.maxunicode + 1):
        char = chr(point)
        if 0xAC00 <= point <= 0xD7A3 or 0xD800 <= point <= 0xDFFF:
            continue
        same = unicodedata.normalize("NFKC", char)
        if same != char and len(same) == 1 and not unicodedata.combining(char):
            source.append(char)
            target.append(same)
        elif same != char:
            several[char] = same
        elif len(apart := unicodedata.normalize("NFD", char)) > 1:
            several[apart] = char
    return "".join(source), "".join(target), several


@lru_cache(maxsize=1)
def _stable() -> tuple[str, ...]:
    """Characters of Western texts beside those of ASCII that stand for themselves; texts of such need no table."""
    return tuple(c for c in map(chr, range(0x80, 0x100)) if unicodedata.normalize("NFKC", c) == c)


@lru_cache(maxsize=1)
def _marking() -> tuple[dict[str, str], dict[str, str], dict[str, str]]:
    """What characters decompose into, the class of each combining mark, and what two characters compose to; syllables of Hangul stay."""
    apart, classes, pairs = {}, {}, {}
    for point in range(0x80, sys.maxunicode + 1):
        char = chr(point)
        if 0xAC00 <= point <= 0xD7A3 or 0xD800 <= point <= 0xDFFF:
            continue
        if (same := unicodedata.normalize("NFKD", char)) != char:
            apart[char] = same
        if of := unicodedata.combining(char):
            classes[char] = str(of)
        two = unicodedata.decomposition(char).split()
        if len(two) == 2 and not two[0].startswith("<") and unicodedata.normalize("NFC", char) == char:
            pairs["".join(chr(int(c, 16)) for c in two)] = char
    return apart, classes, pairs


def _composed_run(run: Column) -> Column:
    """A letter with any marks in canonical order, composed two by two: a mark joins its letter unless one of its own class or a higher one stands between."""
    apart, classes, pairs = map(_looked_up, _marking())
    chars = F.flatten(F.transform(F.split(run, ""), lambda c: F.split(F.coalesce(apart(c), c), "")))
    told = F.transform(chars, lambda c, i: F.struct(i.alias("i"), c.alias("c"), F.coalesce(classes(c).cast("int"), F.lit(0)).alias("k")))

    def ordered(all_: Column) -> Column:
        # marks change places within the stretch that no character of class 0 interrupts
        return F.array_sort(F.transform(all_, lambda x: F.struct(F.size(F.filter(all_, lambda y: (y["k"] == 0) & (y["i"] <= x["i"]))).alias("part"), x["k"].alias("k"), x["i"].alias("i"), x["c"].alias("c"))))

    start = F.struct(F.lit("").alias("out"), F.lit("").alias("letter"), F.lit("").alias("tail"), F.lit(0).alias("last"))

    def step(acc: Column, x: Column) -> Column:
        both = pairs(F.concat(acc["letter"], x["c"]))
        joins = both.isNotNull() & ((acc["tail"] == "") | (acc["last"] < x["k"]))

        def state(out: Column, letter: Column, tail: Column, last: Column) -> Column:
            return F.struct(out.alias("out"), letter.alias("letter"), tail.alias("tail"), last.alias("last"))

        fresh = state(F.concat(acc["out"], acc["letter"], acc["tail"]), x["c"], F.lit(""), F.lit(0))
        return F.when(joins, state(acc["out"], both, acc["tail"], acc["last"])).when(x["k"] == 0, fresh).otherwise(state(acc["out"], acc["letter"], F.concat(acc["tail"], x["c"]), x["k"]))

    return F.reduce(let(told, ordered), start, step, lambda acc: F.concat(acc["out"], acc["letter"], acc["tail"]))


def _any_of(characters: list[str]) -> str:
    """A character class, written as ranges under spans that hold GUARDED of them; what is in no span, as ASCII is, costs one test and not one for each range."""
    points, ranges = sorted(map(ord, characters)), []
    for p in points:
        if ranges and p == ranges[-1][1] + 1:
            ranges[-1][1] = p
        else:
            ranges.append([p, p])

    def told(a: int, b: int) -> str:
        return f"\\x{{{a:x}}}-\\x{{{b:x}}}"

    def span(parts: list[list[int]], held: str) -> str:
        return f"[{told(parts[0][0], parts[-1][1])}&&[{held}]]"

    groups = [ranges[i : i + GUARDED] for i in range(0, len(ranges), GUARDED)]
    return span(ranges, "".join(span(g, "".join(told(*r) for r in g)) for g in groups))


def _looked_up(table: dict[str, str]) -> Callable[[Column], Column]:
    """What a table has for a text, or null. The table is dealt by the first character, as a map is searched from its beginning."""
    dealt: list[dict[str, str]] = [{} for _ in range(DEALT)]
    for k, v in table.items():
        dealt[ord(k[0]) % DEALT][k] = v
    maps = F.from_json(F.lit(json.dumps(dealt)), "array<map<string,string>>")
    return lambda c: F.try_element_at(F.get(maps, F.ascii(c) % DEALT), c)


def fold(text: Column) -> Column:
    """Compatibility characters to their letters, accents off, lower case, white space collapsed and trimmed; null is empty."""
    source, target, marks = _folding()
    spelled = _spelled()
    plain = F.translate(F.coalesce(text, F.lit("")), source + marks, target)
    table = _looked_up(spelled)
    apart = F.array_join(F.transform(F.split(plain, ""), lambda c: F.coalesce(table(c), c)), "")
    plain = F.lower(F.when(plain.rlike(_any_of(list(spelled))), apart).otherwise(plain))
    return F.trim(F.regexp_replace(plain, r"(?U)\s+", " "))


def compatible(text: Column) -> Column:
    """Compatibility characters to what they stand for, letters and their marks composed, runs of blanks and tabs to one blank, trimmed; lines stay. Null is empty.

    Equal to the standard compatibility composition, but for blanks and for syllables of Hangul that are written in letters.
    """
    source, target, several = _composed()
    plain = F.translate(F.coalesce(text, F.lit("")), source, target)
    table = _looked_up(several)
    whole = F.array_join(F.transform(F.regexp_extract_all(plain, F.lit(r"(?s)\P{M}\p{M}*|\p{M}+"), F.lit(0)), lambda c: F.coalesce(table(c), F.when(c.rlike(r"\p{M}"), _composed_run(c)), c)), "")
    plain = F.when(plain.rlike(_any_of([k for k in several if len(k) == 1]) + r"|\p{M}"), whole).otherwise(plain)
    plain = F.when(text.rlike(rf"^[\x00-\x7f{''.join(_stable())}]*$"), text).otherwise(plain)
    return F.regexp_replace(F.regexp_replace(plain, r"[ \t]+", " "), r"(?U)^\s+|\s+$", "")


def words(folded: Column, least: int = 1) -> Column:
    """The distinct runs of a-z and 0-9 of a folded text, in order, of at least some length."""
    return F.array_distinct(F.filter(F.split(F.regexp_replace(folded, "[^a-z0-9]+", " "), " "), lambda w: F.length(w) >= least))


def without_urls(text: Column) -> Column:
    """A text with a space for each web address."""
    return F.regexp_replace(text, r"https?://\S+", " ")


def let(value: Column, of: Callable[[Column], Column]) -> Column:
    """What a function makes of a value that is computed once, however often the function reads it."""
    return F.get(F.transform(F.array(value), of), F.lit(0))


def jaccard(a: Column, b: Column) -> Column:
    """The Jaccard similarity of two arrays as sets; 0 where either is empty."""
    both = F.size(F.array_intersect(a, b)).cast("double")
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(both / (F.size(F.array_distinct(a)) + F.size(F.array_distinct(b)) - both))


def first_distinct(values: Column, limit: int | None = None) -> Column:
    """Values with blanks collapsed and edge punctuation off, the first of each regardless of case, empty ones dropped, at most `limit`."""
    edge = r"^[ .,;:\-·|]+|[ .,;:\-·|]+$"
    neat = F.filter(F.transform(values, lambda v: F.regexp_replace(F.trim(F.regexp_replace(v, r"(?U)\s+", " ")), edge, "")), lambda v: v != "")
    empty = F.array().cast("array<string>")
    kept = F.aggregate(neat, empty, lambda acc, v: F.when(F.exists(acc, lambda x: F.lower(x) == F.lower(v)), acc).otherwise(F.array_append(acc, v)))
    return kept if limit is None else F.slice(kept, 1, limit)


def ascii_bounds(pattern: str) -> str:
    """A pattern whose boundaries of words are those of ASCII letters, digits and the underscore, as in SQL engines; Java takes all letters for letters of words."""
    return pattern.replace(r"\b", r"(?:(?<=\w)(?!\w)|(?<!\w)(?=\w))")


def _plain_choice(pattern: str) -> bool:
    """Whether a pattern has no choice outside of brackets."""
    depth = 0
    for c in re.sub(r"\\.|\[[^\]]*\]", "", pattern):
        depth += (c == "(") - (c == ")")
        if c == "|" and depth == 0:
            return False
    return True


def any_hit(patterns: list[str]) -> str:
    """One pattern that occurs where any of some does; those that begin at a boundary of words are tried at such only."""
    bound = [p for p in patterns if p.startswith(r"\b") and _plain_choice(p)]
    rest = [f"(?:{p})" for p in patterns if p not in bound]
    return "|".join(([r"\b(?:" + "|".join(p[2:] for p in bound) + ")"] if bound else []) + rest)


def needed(pattern: str) -> str:
    """The longest run of characters that whatever a pattern matches holds; empty where none is sure."""
    if re.search(r"\(\?[a-zA-Z-]", pattern) or not _plain_choice(pattern):
        return ""
    flat, depth = [], 0
    for t in re.findall(r"\\.|\[(?:\\.|[^\]])*\]|\{[^}]*\}|.", pattern, re.DOTALL):  # groups, classes and escapes end a run
        depth += t == "("
        if depth == 0:
            flat.append(t)
        elif t == ")":
            depth -= 1
            flat.append("()")
    runs = [""]
    for t, behind in zip(flat, [*flat[1:], ""], strict=True):
        if len(t) > 1 or t in ".^$?*+" or behind[:1] in ("?", "*", "{"):
            runs.append("")
        else:
            runs[-1] += t
    return max(runs, key=len)


def occurs(text: Column, pattern: str) -> Column:
    """Whether a pattern occurs; it is tried only where the characters that it needs stand, which a plain search tells at far less cost."""
    run = needed(pattern)
    return text.contains(run) & text.rlike(pattern) if len(run) > 1 else text.rlike(pattern)


def hits(folded: Column, patterns: list[str]) -> Column:
    """How many of some patterns occur."""
    return sum((occurs(folded, p).cast("int") for p in patterns), F.lit(0))
