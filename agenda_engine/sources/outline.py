"""The outline of a page: its elements and its texts as two flat lists, which column expressions then read.

Python only turns markup into the lists, with a stack of its own, so nesting of any depth is read; what a page says is decided in columns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from agenda_engine.functions.durable import spread
from agenda_engine.functions.shipping import ship
from agenda_engine.functions.text import let

# Fixed values of the markup: elements without an end, and elements that end where a like one begins, up to what holds them.
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"))
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "p": ({"p"}, {"div", "section", "article", "main", "td", "li", "body"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}), "option": ({"option"}, {"select"}),
}
SILENT, FURNITURE = frozenset(("script", "style")), frozenset(("script", "style", "noscript", "svg", "header", "footer", "nav"))
#: What an element can stand in that a reader asks for: tags, .classes and #ids.
WATCHED = ("article", "main", "header", ".event", ".entry-content")
OUTLINE = (
    "outline struct<tags:array<struct<i:int,tag:string,last:int,from:int,to:int,attrs:map<string,string>,inside:array<string>,furniture:boolean>>,"
    "texts:array<struct<said:string,silent:boolean,furniture:boolean>>,ld:array<string>>"
)


class Outline(HTMLParser):
    """tags: each with the number of its last descendant and its range of texts; texts: trimmed, none blank; ld: linked-data scripts."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tags = [{"i": 0, "tag": "", "last": 0, "from": 0, "to": 0, "attrs": {}, "inside": [], "furniture": False}]
        self.texts: list[dict] = []
        self.ld: list[str] = []
        self.open, self.silent = [0], 0
        self.within: list[list[str] | None] = [None]  # what a child of each open element stands in, once it has one

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ENDS:
            ended, held = ENDS[tag]
            for depth in range(len(self.open) - 1, 0, -1):
                name = self.tags[self.open[depth]]["tag"]
                if name in ended:
                    self._end(depth)
                if name in ended or name in held:
                    break
        up = self.tags[self.open[-1]]
        if (inside := self.within[-1]) is None:
            own = up["attrs"]
            told = {up["tag"], f"#{own.get('id')}", *(f".{c}" for c in own.get("class", "").split())}
            inside = self.within[-1] = sorted({*up["inside"], *told.intersection(WATCHED)})
        of = {k: v or "" for k, v in attrs}
        at, said = len(self.tags), len(self.texts)
        self.tags.append({"i": at, "tag": tag, "last": at, "from": said, "to": said, "attrs": of, "inside": inside, "furniture": up["furniture"] or tag in FURNITURE})
        if tag == "script" and of.get("type") == "application/ld+json":
            self.ld.append("")
        if tag not in VOID:
            self.open.append(at)
            self.within.append(None)
            self.silent += tag in SILENT

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def _end(self, depth: int) -> None:
        for at in self.open[depth:]:
            node = self.tags[at]
            node["last"], node["to"] = len(self.tags) - 1, len(self.texts)
            self.silent -= node["tag"] in SILENT
        del self.open[depth:], self.within[depth:]

    def handle_endtag(self, tag: str) -> None:
        for depth in range(len(self.open) - 1, 0, -1):
            if self.tags[self.open[depth]]["tag"] == tag:
                self._end(depth)
                break

    def handle_data(self, data: str) -> None:
        at = self.tags[self.open[-1]]
        if at["tag"] == "script" and at["attrs"].get("type") == "application/ld+json":
            self.ld[-1] += data
        if said := data.strip():
            self.texts.append({"said": said, "silent": self.silent > 0, "furniture": at["furniture"]})

    def close(self) -> None:
        super().close()
        self._end(0)


def outline(html: str | None) -> dict:
    """The lists of a page; an end tag that opens nothing is passed over."""
    reader = Outline()
    reader.feed(html or "")
    reader.close()
    for t in reader.tags:
        t["attrs"] = list(t["attrs"].items())
    return {"tags": reader.tags, "texts": reader.texts, "ld": reader.ld}


def outlined(pages: DataFrame, html: str = "html", deal: Callable[[DataFrame], DataFrame] = spread) -> DataFrame:
    """Pages with their outline in place of their markup.

    deal lays the pages over the cores. To count the parts of a join, spread runs it, and it runs again behind: a join's pages are dealt.
    """
    ship(pages.sparkSession)
    kept = [c for c in pages.columns if c != html]
    kinds = to_arrow_schema(StructType.fromDDL(OUTLINE)).field(0).type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                made = pa.array([outline(h) for h in part.column(len(kept)).to_pylist()], kinds)
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(kept))), made], [*kept, "outline"])

    told = ", ".join([*(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in kept), OUTLINE])
    return deal(pages.select(*kept, html)).mapInArrow(run, told)


# Reading an outline

TAGS, TEXTS = "outline.tags", "outline.texts"


def tags(fits: Callable[[Column], Column]) -> Column:
    """The elements that fit, in order."""
    return F.filter(TAGS, fits)


def first(*choices: Callable[[Column], Column]) -> Column:
    """The first element that fits the first choice that any element fits, or null."""
    return F.coalesce(*(F.get(tags(c), F.lit(0)) for c in choices))


def named(*names: str) -> Callable[[Column], Column]:
    """Elements with one of some tags."""
    return lambda t: t["tag"].isin(*names)


def attr(t: Column, name: str) -> Column:
    """An attribute of an element; null where it has none."""
    return F.try_element_at(t["attrs"], F.lit(name))


def strings(t: Column, furniture: bool = True) -> Column:
    """The texts of an element; without those of the page's furniture where these are no part of it."""
    own = let(t, lambda n: F.slice(TEXTS, n["from"] + 1, n["to"] - n["from"]))
    return F.transform(F.filter(own, lambda x: ~x["silent"] if furniture else ~x["furniture"]), lambda x: x["said"])


def text(t: Column, furniture: bool = True) -> Column:
    """All texts of an element as one."""
    return F.array_join(strings(t, furniture), " ")


def filled(*values: Column) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*(F.nullif(v, F.lit("")) for v in values))
