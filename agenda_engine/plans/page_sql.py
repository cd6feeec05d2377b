"""Queries over pages that are SQL themselves, by the table functions of pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from agenda_engine.functions.durable import spread
from agenda_engine.plans.book import query
from agenda_engine.plans.lifted import table
from agenda_engine.sources import tables

LINKS = """
    WITH e AS (SELECT page_id, i, first_text, end_text, attrs['href'] AS href FROM {pages}, LATERAL page_elements(html) WHERE tag = 'a' AND attrs['href'] <> ''),
    said AS (SELECT page_id, n, t.said FROM {pages}, LATERAL page_texts(html) t WHERE NOT silent),
    spans AS (SELECT page_id, i, href, n FROM e LATERAL VIEW OUTER explode(CASE WHEN end_text > first_text THEN sequence(first_text, end_text - 1) END) x AS n),
    met AS (SELECT s.page_id, i, any_value(href) AS href, array_join(transform(array_sort(collect_list(CASE WHEN said IS NOT NULL THEN struct(s.n, said) END)), x -> x.said), ' ') AS said
      FROM spans s LEFT JOIN said t ON s.page_id = t.page_id AND s.n = t.n GROUP BY s.page_id, i)
    SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) AS INT) AS place, href, said FROM met"""


@query(r"""
    WITH l AS (SELECT page_id, regexp_extract_all(html, '<a href="([^"]+)"[^>]*>([^<]*)</a>', 1) AS h, regexp_extract_all(html, '<a href="([^"]+)"[^>]*>([^<]*)</a>', 2) AS s FROM pages),
    u AS (SELECT page_id, unnest(h) AS href, unnest(s) AS said, generate_subscripts(h, 1)::INTEGER AS place FROM l)
    SELECT page_id, place, replace(href, '&amp;', '&') AS href, trim(replace(said, '&amp;', '&')) AS said FROM u""")
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The links of every page in order, with what they say: a lateral join of pages and their elements and texts."""
    tables.register(spark)
    return spark.sql(LINKS, pages=spread(table(spark, sf_dir, "pages").select("page_id", "html")))
