"""Pages as tables of SQL: functions in a lateral join, and the view of what readers find."""

from __future__ import annotations

from agenda_engine.plans import page_sql
from agenda_engine.sources import sites, tables

LISTING = """<html><head><script type="application/ld+json">{"@type":"Event","name":"Feria"}</script></head><body><a name="x">sin destino</a>
<ul><li><a href="/a?x=1&amp;y=2"><b>Uno</b> y <i>dos</i></a><li><a href="/b"></a></ul><script>var t = "<a href='/no'>no</a>";</script><a href="/c">tres</a></body></html>"""


def test_functions_stand_in_a_lateral_join(spark):
    tables.register(spark)
    deep = "<div>" * 3000 + "hondo"
    pages = spark.createDataFrame([(1, LISTING), (2, None), (3, ""), (4, deep), (5, LISTING)], "page_id long, html string")
    links = [tuple(r) for r in spark.sql(page_sql.LINKS, pages=pages).orderBy("page_id", "place").collect()]
    want = [(1, "/a?x=1&y=2", "Uno y dos"), (2, "/b", ""), (3, "/c", "tres")]
    assert links == [(page, *x) for page in (1, 5) for x in want]
    counts = spark.sql("SELECT page_id, count(*) AS n, max(last) AS last FROM {p}, LATERAL page_elements(html) GROUP BY page_id", p=pages).collect()
    assert {r.page_id: (r.n, r.last) for r in counts}[4] == (3001, 3000) and {r.page_id: r.n for r in counts}[2] == 1
    assert [tuple(r) for r in spark.sql("SELECT n, said, silent FROM {p}, LATERAL page_texts(html) WHERE page_id = 4", p=pages).collect()] == [(0, "hondo", False)]
    assert [tuple(r) for r in spark.sql("SELECT page_id, n, get_json_object(block, '$.name') AS name FROM {p}, LATERAL page_blocks(html) ORDER BY page_id", p=pages).collect()] == [(1, 0, "Feria"), (5, 0, "Feria")]
    assert spark.sql("SELECT * FROM {p}, LATERAL page_elements(html)", p=pages.limit(0)).count() == 0


def test_the_view_holds_what_the_readers_find(spark):
    sources = "id string, name string, type string, source_class string, tier int, url string, region string, city string, icon_url string, parser string, max_items int, max_salas int"
    known = spark.createDataFrame([("s", "S", "web", "eventos", 1, "https://w.example/", "Oruro", "Oruro", None, None, None, None)], sources)
    pages = spark.createDataFrame([("s", "https://w.example/", LISTING, True)], "source_id string, url string, html string, is_root boolean")
    tables.create_views(pages, known, "2026-08-14T10:00:00")
    found = spark.sql("SELECT i.*, s.name FROM page_items i JOIN page_sources s ON i.source_id = s.id").drop("name").collect()
    assert [r.title for r in found] == ["Feria"] and found == sites.read_all(pages, known, "2026-08-14T10:00:00").collect()
