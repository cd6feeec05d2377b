"""Captured web pages: structured events, body text, titles and links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agenda_engine.functions.durable import cut
from agenda_engine.functions.text import let

# Event types of the structured vocabulary, keys that nest events, words that make a link worth following.
EVENT_TYPES = (
    "event", "musicevent", "theaterevent", "festival", "sportsevent", "socialevent", "businessevent", "educationevent", "exhibitionevent", "screeningevent",
    "comedyevent", "danceevent", "foodevent", "childrensevent", "literaryevent", "visualartsevent",
)
NESTING = ("@graph", "itemListElement", "item", "subEvent", "events")
#: Steps up and in place of an address that are resolved, at most.
DOTTED = 4
DROPPED = ("script", "style", "noscript", "svg", "header", "footer", "nav")


def ld_blocks(html: Column) -> Column:
    """The JSON texts of all linked-data scripts of a page."""
    return F.regexp_extract_all(html, F.lit(r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>"), F.lit(1))


def absolute(base: Column, href: Column) -> Column:
    """An address seen from a page, as browsers resolve it; null for anything but the web."""
    return let(F.struct(base.alias("base"), F.trim(href).alias("href")), lambda x: let(_joined(x["base"], x["href"]), _plain))


def _joined(base: Column, href: Column) -> Column:
    """The address of a page with a reference in the place that the reference's form says."""
    root, path, page = F.regexp_extract(base, r"^(https?://[^/?#]*)", 1), F.regexp_extract(base, r"^https?://[^/?#]*([^?#]*)", 1), F.regexp_replace(base, "#.*$", "")
    folder = F.concat(root, F.when(path == "", "/").otherwise(F.regexp_replace(path, "[^/]*$", "")))
    return (
        F.when(href == "", page).when(href.rlike("^(?i:https?)://"), href).when(href.startswith("//"), F.concat(F.regexp_extract(base, "^(https?:)", 1), href)).when(href.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
        .when(href.startswith("/"), F.concat(root, href)).when(href.startswith("?"), F.concat(root, path, href)).when(href.startswith("#"), F.concat(page, href)).otherwise(F.concat(folder, href))
    )


def _plain(url: Column) -> Column:
    """An address without steps up and in place, and null for an empty one."""
    plain = url
    for _ in range(DOTTED):
        plain = F.regexp_replace(F.regexp_replace(plain, r"/[.](?=/|$)", ""), r"^(https?://[^/?#]+(?:/[^/?#]+)*?)/(?![.][.](?:/|$))[^/?#]+/[.][.](?=/|$)", "$1")
    plain = F.regexp_replace(plain, r"^(https?://[^/?#]+)(?:/[.][.])+(?=/|$)", "$1")
    return F.nullif(F.when(url.rlike(r"/[.]{1,2}(/|$)"), plain).otherwise(url), F.lit(""))


def flatten_events(pages: DataFrame, html: str = "html", step: int = 4, blocks: str | None = None) -> DataFrame:
    """Adds event (a VARIANT) and at (its place), a row for each structured event with a name, however deep it is nested; blocks that are no JSON are skipped.

    blocks names a column of linked-data texts, where the page has been read already. Nesting is unrolled level by level with native variant functions, `step` levels in one pass; passes over a written table
    follow while any block has deeper levels.
    """
    own = [c for c in pages.columns if c not in (html, blocks)]
    texts = F.col(blocks) if blocks else ld_blocks(F.col(html))
    found = pages.select(*own, F.posexplode(texts).alias("n", "block")).select(*own, F.array("n").alias("at"), F.try_parse_json("block").alias("v"), F.lit(True).alias("fresh")).where("v is not null")
    found = _levels(found, own, step)
    while True:
        found = cut(found.withColumn("v", F.to_json("v"))).withColumn("v", F.parse_json("v"))
        if not found.where("fresh").limit(1).count():
            break
        found = _levels(found, own, step)
    kind = F.coalesce(F.try_variant_get("v", "$['@type']", "array<string>"), F.array(F.try_variant_get("v", "$['@type']", "string")))
    named = F.trim(F.coalesce(F.try_variant_get("v", "$.name", "string"), F.lit(""))) != ""
    return found.where(F.exists(kind, lambda t: F.lower(t).isin(*EVENT_TYPES)) & named).select(*own, "at", F.col("v").alias("event"))


def _levels(found: DataFrame, own: list[str], many: int) -> DataFrame:
    """Unrolls some levels of nesting."""
    for _ in range(many):
        # one step: a fresh array becomes its elements, a fresh object stays and brings what it nests, all else stays
        def below(values: Column) -> Column:
            return F.transform(values, lambda x, i: F.struct(x.alias("v"), F.lit(True).alias("fresh"), F.array_append("at", i).alias("at")))

        inner = F.flatten(F.array_compact(F.array(*(F.coalesce(F.try_variant_get("v", f"$['{k}']", "array<variant>"), F.array_compact(F.array(F.try_variant_get("v", f"$['{k}']", "variant")))) for k in NESTING))))
        itself = F.array(F.struct(F.col("v").alias("v"), F.lit(False).alias("fresh"), F.col("at").alias("at")))
        is_array = F.startswith(F.schema_of_variant("v"), F.lit("ARRAY"))
        step = F.when(~F.col("fresh"), itself).when(is_array, below(F.try_variant_get("v", "$", "array<variant>"))).otherwise(F.concat(itself, below(inner)))
        found = found.select(*own, F.explode(step).alias("s")).select(*own, "s.at", "s.v", "s.fresh").where("v is not null")
    return found


def _text(v: Column, path: str) -> Column:
    """The text or number at a path; null where an object or a list stands there."""
    nested = F.coalesce(F.schema_of_variant(F.try_variant_get(v, path, "variant")).rlike("^(OBJECT|ARRAY)"), F.lit(False))
    return F.when(~nested, F.nullif(F.trim(F.try_variant_get(v, path, "string")), F.lit("")))


def offers(v: Column) -> Column:
    """struct<price_from, price_to, currency, is_free, urls> of an event's offers, one or many, priced alone or as a range."""
    many = F.coalesce(F.try_variant_get(v, "$.offers", "array<variant>"), F.array_compact(F.array(F.try_variant_get(v, "$.offers", "variant"))))

    def of(path: str, kind: str) -> Column:
        return F.array_compact(F.transform(many, lambda o: F.try_variant_get(o, path, kind)))

    amounts = F.array_compact(F.transform(F.concat(of("$.price", "string"), of("$.lowPrice", "string"), of("$.highPrice", "string")), lambda p: F.replace(p, F.lit(","), F.lit(".")).try_cast("double")))
    return F.struct(
        F.array_min(amounts).alias("price_from"), F.array_max(amounts).alias("price_to"),
        F.get(of("$.priceCurrency", "string"), 0).alias("currency"), ((F.size(amounts) > 0) & (F.array_max(amounts) == 0)).alias("is_free"),
        F.slice(F.array_distinct(of("$.url", "string")), 1, 8).alias("urls"), of("$.url", "string").alias("every_url"),
    )


def event_columns(v: Column) -> list[Column]:
    """The fields of a structured event; location, image and organizer may be texts, objects or lists."""
    place = F.try_variant_get(v, "$.location", "variant")
    address = F.concat_ws(", ", *(F.try_variant_get(place, f"$.address.{k}", "string") for k in ("streetAddress", "addressLocality", "addressRegion")))
    image = F.coalesce(*(_text(v, p) for p in ("$.image.url", "$.image[0].url", "$.image[0]", "$.image")))
    offer = offers(v)
    return [
        _text(v, "$.name").alias("title"), _text(v, "$.startDate").alias("starts_at"), _text(v, "$.endDate").alias("ends_at"), _text(v, "$.url").alias("url"),
        _text(v, "$.description").alias("description"), F.coalesce(_text(v, "$.location.name"), _text(v, "$.location")).alias("venue"),
        F.coalesce(_text(v, "$.location.address"), F.nullif(address, F.lit(""))).alias("address"), image.alias("image_url"),
        F.coalesce(_text(v, "$.organizer.name"), _text(v, "$.organizer[0].name"), _text(v, "$.organizer")).alias("organizer"), offer.alias("offer"),
    ]


def event_extras(v: Column) -> list[Column]:
    """Further fields of a structured event: audience, genre, pictures, what its offers say, and its video."""
    def many(path: str) -> Column:
        return F.coalesce(F.try_variant_get(v, path, "array<variant>"), F.array_compact(F.array(F.try_variant_get(v, path, "variant"))))

    said = F.array_compact(F.flatten(F.transform(many("$.offers"), lambda o: F.array(*(F.try_variant_get(o, f"$.{k}", "string") for k in ("price", "lowPrice", "highPrice"))))))
    said = F.array_sort(F.array_distinct(F.filter(said, lambda s: s != "")))
    moving = F.get(many("$.video"), F.lit(0))
    stated = [_text(moving, f"$.{k}") for k in ("embedUrl", "contentUrl", "url")]
    return [
        F.coalesce(_text(v, "$.audience.name"), _text(v, "$.audience[0].name"), _text(v, "$.audience")).alias("audience"), _text(v, "$.genre").alias("content_genre"),
        F.array_compact(F.transform(many("$.image"), lambda p: F.coalesce(_text(p, "$.url"), _text(p, "$")))).alias("pictures"),
        F.when(F.size(said) > 0, F.concat(F.lit("Bs "), F.array_join(said, " - "))).alias("price_said"),
        F.coalesce(*stated, _text(moving, "$")).alias("moving"), F.coalesce(*stated).isNotNull().alias("framed"),
        F.coalesce(*(_text(moving, f"$.{k}") for k in ("thumbnailUrl[0]", "thumbnailUrl", "thumbnail[0]", "thumbnail"))).alias("still"),
    ]


def title(html: Column) -> Column:
    """What stands in the page's title element, white space collapsed; entities stay as they are written."""
    raw = F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)
    return F.trim(F.regexp_replace(raw, r"\s+", " "))


def links(html: Column) -> Column:
    """The targets of a page's links, in order, each once."""
    return F.array_distinct(F.regexp_extract_all(html, F.lit(r"(?i)<a\s[^>]*href=[\"']([^\"'#]+)"), F.lit(1)))


def host(url: Column) -> Column:
    """The host of an address, in lower case."""
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def body_text(html: Column) -> Column:
    """The text of a page without the parts that are no content."""
    bare = html
    for tag in DROPPED:
        bare = F.regexp_replace(bare, rf"(?is)<{tag}\b[^>]*>.*?</{tag}>", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(bare, r"(?s)<[^>]*>", " "), r"\s+", " "))


def followed(pages: DataFrame, relevant: str, most: int = 12) -> DataFrame:
    """(source_id, url, place): of each root page, the first links to its own host whose address is relevant and that was captured too."""
    roots = pages.where("is_root").select("source_id", F.col("url").alias("root"), F.posexplode(links(F.col("html"))).alias("place", "url"))
    own = roots.where((host(F.col("url")) == host(F.col("root"))) & F.lower("url").rlike(relevant))
    met = own.join(pages.select("source_id", "url"), ["source_id", "url"], "left_semi")
    first = Window.partitionBy("source_id").orderBy("place")
    return met.withColumn("n", F.row_number().over(first)).where(F.col("n") <= most).select("source_id", "url", "place")
