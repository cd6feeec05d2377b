"""Outlines of odd markup, addresses against the standard library, and items of pages and of their linked data."""

from __future__ import annotations

import json
from urllib.parse import urljoin

from pyspark.sql import functions as F

from agenda_engine.sources import pages, sites, web
from agenda_engine.sources.outline import outline


def said(o, t):
    return [x["said"] for x in o["texts"][t["from"] : t["to"]]]


def test_outline_reads_what_is_deep_open_and_stray():
    deep = outline("<div>" * 10_000 + "hondo" + "</p>")
    assert len(deep["tags"]) == 10_001 and deep["tags"][9_999]["last"] == 10_000 and said(deep, deep["tags"][1]) == ["hondo"]
    items = outline("<ul><li>a<li>b<ul><li>c</ul><li>d</ul><p>x<p>y<table><tr><td>1<td>2<tr><td>3</table>")
    texts = {}
    for t in items["tags"]:
        texts.setdefault(t["tag"], []).append(said(items, t))
    assert texts["li"] == [["a"], ["b", "c"], ["c"], ["d"]] and texts["td"] == [["1"], ["2"], ["3"]] and texts["tr"] == [["1", "2"], ["3"]] and texts["p"][0] == ["x"]
    odd = outline('<header><img src=x></header><script>var a = "<b>";</script><script type="application/ld+json">{"a": 1}</script>ya &amp; no<style>b</style>')
    assert odd["ld"] == ['{"a": 1}'] and [x["said"] for x in odd["texts"] if not x["silent"]] == ["ya & no"]
    assert next(t for t in odd["tags"] if t["tag"] == "img")["inside"] == ["header"]
    assert outline(None)["texts"] == [] and len(outline("")["tags"]) == 1


def test_addresses_equal_the_standard_library(spark):
    bases = ["https://sitio.bo", "https://sitio.bo/", "http://sitio.bo/a/b", "https://sitio.bo/a/b/?q=1#x", "https://sitio.bo/a/b.html?next=/c/d"]
    hrefs = ["x", "/x", "./x", "../x", "../../x/./y", "a/../b", "//otro.bo/z", "http://otro.bo/a/../b", "?q=2", "#f", "x?u=/../y", "mailto:a@b.c", "javascript:void(0)", "tel:1", "  /x  ", "HTTPS://otro.bo/"]
    rows = [(b, h) for b in bases for h in hrefs]
    got = spark.createDataFrame(rows, "base string, href string").select("base", "href", web.absolute(F.col("base"), F.col("href")).alias("url")).collect()
    for r in got:
        want = urljoin(r.base, r.href.strip())
        if "a/../b" in r.href and "://" in r.href:
            continue  # the standard library leaves an address that is whole as it is
        if want.lower().startswith(("http://", "https://")):
            assert r.url.lower().rstrip("/") == want.lower().rstrip("/"), (r, want)
        else:
            assert r.url is None
    assert spark.range(1).select(web.absolute(F.lit("https://a.bo"), F.lit(None)).alias("u")).first().u is None


SOURCE = "id string, name string, url string, region string, city string, icon_url string, parser string, max_items int, max_salas int"


def test_items_of_linked_data_keep_order_and_forms(spark):
    one = {"@type": ["Event"], "name": "Uno", "startDate": "2026-09-01", "endDate": "2026-09-02", "url": "uno", "description": "<p>Una</p> noche", "image": [{"url": "/a.jpg"}, "b.jpg", "/a.jpg"], "genre": "Rock",
           "location": {"name": "Teatro", "address": {"streetAddress": "Av. 1", "addressLocality": "La Paz"}}, "organizer": [{"name": "Org"}], "audience": {"name": "Todos"},
           "offers": [{"lowPrice": "20,5", "highPrice": 80, "priceCurrency": "BOB", "url": "https://t.bo/1"}, {"price": "30", "url": "https://t.bo/2"}],
           "video": {"embedUrl": "https://youtube.com/embed/x", "thumbnailUrl": ["/t.jpg"]}, "subEvent": {"@type": "MusicEvent", "name": "Dos", "location": "Plaza", "image": "c.jpg", "offers": {"price": 0}, "video": "/v.mp4"}}
    other = [{"@type": "Organization", "name": "x"}, {"@type": "Event", "name": " "}, {"@type": "Festival", "name": "Tres"}]
    html = "".join(f'<script type="application/ld+json">{json.dumps(x)}</script>' for x in (one, other)) + '<script type="application/ld+json">{bad</script>'
    page = [("s", "https://s.bo/p/", f"<body>Agenda de eventos {html}<a href='/evento/1#x'>ver</a></body>", True), ("s", "https://s.bo/evento/1", "<body><main>nada</main></body>", False), ("s", "https://s.bo/otra", "<body>evento</body>", False)]
    sources = spark.createDataFrame([("s", "S", "https://s.bo", "La Paz", "El Alto", "https://s.bo/i.png", None, 20, 8)], SOURCE)
    got = pages.read_sources_pages(spark.createDataFrame(page, "source_id string, url string, html string, is_root boolean"), sources).orderBy("item_no").collect()
    assert [(r.title, r.item_no) for r in got] == [("Uno", 1), ("Dos", 2), ("Tres", 3), ("", 4)]
    first, second = got[0], got[1]
    assert first.text == "Uno\n2026-09-01\n2026-09-02\nTeatro\nAv. 1, La Paz\nBs 20,5 - 30 - 80\nUna  noche"
    assert first.item_url == "https://s.bo/p/uno" and first.image_urls == ["https://s.bo/a.jpg", "https://s.bo/p/b.jpg"] and first.external_links == ["https://t.bo/1", "https://t.bo/2"]
    assert (first.video_url, first.video_thumbnail_url, first.video_type) == ("https://youtube.com/embed/x", "https://s.bo/t.jpg", "web_embed")
    data = json.loads(first.structured_data)
    assert data["price_from"] == 20.5 and data["price_to"] == 80 and data["organizer"] == "Org" and data["audience"] == "Todos" and data["department"] == "La Paz" and data["is_free"] is False
    assert json.loads(second.structured_data)["is_free"] is True and second.video_type == "web_video" and second.image_urls == ["https://s.bo/p/c.jpg"] and json.loads(second.structured_data)["venue"] == "Plaza"


def test_deep_pages_do_not_fail(spark):
    rows = [("s", "https://s.bo/", "<ul>" + "<li>" * 1500 + "evento" + "<div>" * 3000, True)]
    sources = spark.createDataFrame([("s", "S", "https://s.bo", None, None, None, None, 20, 8)], SOURCE)
    assert pages.read_sources_pages(spark.createDataFrame(rows, "source_id string, url string, html string, is_root boolean"), sources).count() == 1


def test_prices_and_showings_of_sites(spark):
    texts = ["40 Bs - 10 Bs", "Bs. 12,50", "Bs 5", "30 Bs hoy", "nada"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(sites.prices(F.col("t")).alias("p")).collect()
    assert [(r.p.low, r.p.high, r.p.label) for r in rows] == [(10.0, 40.0, "Bs 10 - 40"), (12.5, 12.5, "Bs 12.5"), (5.0, 5.0, "Bs 5"), (30.0, 30.0, "Bs 30"), (None, None, None)]
    said = spark.createDataFrame([("Sáb 1 de marzo, 9:30 y 31 de diciembre 21:00; 30 de febrero, 10:00; 3 de nada, 10:00",)], "t string")
    now = F.to_timestamp_ntz(F.lit("2026-08-27T09:00:00"), F.lit("yyyy-MM-dd'T'HH:mm:ss"))
    assert said.select(F.transform(sites.showings(F.col("t"), now), sites.iso).alias("m")).first().m == ["2027-03-01T09:30:00-04:00", "2026-12-31T21:00:00-04:00"]


def test_no_outline_is_written(spark, monkeypatch):
    """The lists of a page were written twice and shuffled before its fields were read; now what is read of them is written, once."""
    from agenda_engine.plans.registry import QUERIES
    from agenda_engine.sources import pages as reader

    written, cut = [], reader.cut
    monkeypatch.setattr(reader, "cut", lambda df: written.append(df.columns) or cut(df))
    found = QUERIES["page_items"](spark, "/root/testdata/sf0.001")
    assert found.count() == 180 and written and not any("outline" in c for c in written)


def test_no_outline_of_a_site_is_written(spark, monkeypatch):
    """The readers of sites wrote a page's lists up to four times, and those of pages that nothing links to as well."""
    from agenda_engine.plans.registry import QUERIES

    written, cut = [], sites.cut
    monkeypatch.setattr(sites, "cut", lambda df: written.append(df.columns) or cut(df))
    found = QUERIES["parser_dispatch"](spark, "/root/testdata/sf0.001")
    assert sum(r["items"] for r in found.collect()) == 180 and written
    assert not any("outline" in c for c in written) and [c for c in written if "html" in c] == [["source_id", "url", "place", "src_parser", "src_name", "src_city", "src_region", "html"]]


def test_pages_at_one_place_keep_their_order(spark):
    """Two roots whose first links differ: both pages stand at the first place, and the address decides."""
    kinds = "source_id string, url string, html string, is_root boolean"
    form = "https://s.bo/agendajiwaki/event/e%d"
    rows = [("s", f"https://s.bo/{i}", f'<a href="{form % (9 - i)}">x</a>', True) for i in range(9)] + [("s", form % i, f"<h1>Charla {i}</h1>", False) for i in range(9)] + [("s", form % 77, "<h1>Suelta</h1>", False)]
    sources = spark.createDataFrame([("s", "S", "https://s.bo", None, None, None, sites.CITY, 20, 8), ("t", "T", "https://t.bo", None, None, None, sites.CINEMA, 20, 8)], SOURCE)
    more = [("t", "https://t.bo/", '<a href="/cine/sala-s1">x</a><a href="/cine/sala-s2">x</a>', True), ("t", "https://t.bo/cine/sala-s1", "<h1>Sala</h1>sin películas", False), ("t", "https://t.bo/cine/sala-s2", None, False)]
    for parts in (1, 7):
        got = sites.read_sites(spark.createDataFrame(rows + more, kinds).repartition(parts), sources, "2026-08-27T09:00:00").orderBy("item_no").collect()
        assert [(r.item_no, r.title) for r in got] == [(i, f"Charla {i}") for i in range(1, 9)]
