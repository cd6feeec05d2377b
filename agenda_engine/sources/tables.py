"""Pages as tables of SQL: functions that stand in a lateral join, and a view of what every reader finds."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.functions import udtf

from agenda_engine.functions.durable import cut
from agenda_engine.functions.shipping import ship
from agenda_engine.sources import sites
from agenda_engine.sources.outline import outline

ELEMENTS = "i int, tag string, last int, first_text int, end_text int, attrs map<string,string>, inside array<string>, furniture boolean"
TEXTS = "n int, said string, silent boolean, furniture boolean"
BLOCKS = "n int, block string"


class Elements:
    """The elements of a page in order, the page itself as number 0 without a tag; no markup is a page without elements."""

    def eval(self, html: str) -> Iterator[tuple]:
        for t in outline(html)["tags"]:
            yield t["i"], t["tag"], t["last"], t["from"], t["to"], dict(t["attrs"]), t["inside"], t["furniture"]


class Texts:
    """The texts of a page in order: those of element i have first_text <= n < end_text."""

    def eval(self, html: str) -> Iterator[tuple]:
        for n, t in enumerate(outline(html)["texts"]):
            yield n, t["said"], t["silent"], t["furniture"]


class Blocks:
    """The linked-data scripts of a page in order, as they stand there."""

    def eval(self, html: str) -> Iterator[tuple]:
        yield from enumerate(outline(html)["ld"])


def register(spark: SparkSession) -> None:
    """Makes page_elements(html), page_texts(html) and page_blocks(html) table functions of the session's SQL.

    Each is read row by row in a lateral join, so work is split as the table of pages is; a row of any of them holds no more than one element
    or text. Texts of an element are met by a join on the page and each n of its range, so no page has to fit a task.
    """
    ship(spark)
    for name, made, told in (("page_elements", Elements, ELEMENTS), ("page_texts", Texts, TEXTS), ("page_blocks", Blocks, BLOCKS)):
        spark.udtf.register(name, udtf(made, returnType=told))


def create_views(pages: DataFrame, sources: DataFrame, now: str) -> None:
    """The views captured_pages, page_sources and page_items: pages as given, and the items that the readers of all sources find on them.

    The items are read once, when the view is made. now: 'YYYY-MM-DDTHH:MM:SS'.
    """
    register(pages.sparkSession)
    pages.createOrReplaceTempView("captured_pages")
    sources.createOrReplaceTempView("page_sources")
    cut(sites.read_all(pages, sources, now)).createOrReplaceTempView("page_items")
