"""Lexicons of any size as one pattern: a text is read once, however many names are looked for."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from agenda_engine.functions.text import let

WORD = re.compile(r"\w")


def _escaped(text: str) -> str:
    return re.sub(r"([^\w\s])", r"\\\1", text)


def trie(names: list[str]) -> str:
    """A pattern for the longest of some names that begins at a place and that no word character follows.

    Names that begin alike share that beginning, so a text is compared with as many branches as a place has next characters, not with every name.
    """

    def below(rest: list[str]) -> str:
        ends, heads = "" in rest, {}
        for r in rest:
            if r:
                heads.setdefault(r[0], []).append(r)
        branches = []
        for own in heads.values():
            least, most = min(own), max(own)
            shared = next((i for i, c in enumerate(least) if c != most[i]), len(least))
            branches.append(_escaped(least[:shared]) + below([r[shared:] for r in own]))
        branches += [r"(?!\w)"] if ends else []
        return branches[0] if len(branches) == 1 else f"(?:{'|'.join(branches)})"

    return below(sorted(set(names)))


class Lexicon:
    """Names and what each stands for, the name that counts most first. Names begin and end with a word character."""

    def __init__(self, pairs: list[tuple[str, str]]):
        bad = [name for name, _ in pairs if not (name and WORD.match(name[0]) and WORD.match(name[-1]))]
        if bad:
            raise ValueError(f"names must begin and end with a word character: {bad[:3]}")
        rank: dict[str, tuple[int, str]] = {}
        for i, (name, value) in enumerate(pairs):
            rank.setdefault(name, (i, value))
        self.pattern = rf"(?U)(?<!\w)(?=({trie(list(rank))}))" if rank else ""
        # a name that begins with other names stands for the one that counts most
        self.meaning = {name: min((rank[p] for p in self._beginnings(name) if p in rank), key=lambda x: x[0]) for name in rank}

    @staticmethod
    def _beginnings(name: str) -> list[str]:
        return [name[:i] for i in range(1, len(name) + 1) if i == len(name) or not WORD.match(name[i])]

    def found(self, text: Column) -> Column:
        """Every place of a text where a name begins: the longest there, in order, names inside others included."""
        if not self.meaning:
            return F.array().cast("array<string>")
        return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(self.pattern), F.lit(1))

    def first(self, text: Column) -> Column:
        """What the name that counts most among those in a text stands for, or null. The plan is the same for any number of names."""
        table = F.from_json(F.lit(json.dumps({n: {"r": r, "v": v} for n, (r, v) in self.meaning.items()}, ensure_ascii=False)), "map<string,struct<r:int,v:string>>")
        return let(F.array_min(F.transform(F.array_distinct(self.found(text)), lambda n: F.try_element_at(table, n))), lambda best: best["v"])
