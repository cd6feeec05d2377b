"""Social posts as they were captured: interface noise, hints of an event, images that are none; and sources by id and type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Labels of the interface, words that hint at an event, and parts of addresses of images that show nothing.
INTERFACE = (
    "me gusta", "comentar", "compartir", "enviar", "seguir", "seguidores", "reacciones", "todos", "más relevantes", "mas relevantes", "ver más", "ver mas",
    "facebook", "reproducir", "pausar", "silenciar", "activar sonido", "crear cuenta", "iniciar sesión", "iniciar sesion", "ver traducción", "ver traduccion",
    "escribe un comentario", "más opciones", "mas opciones",
)
HINTS = (
    "evento", "concierto", "festival", "feria", "expo", "teatro", "show", "función", "funcion", "entrada", "entradas", "preventa", "boletería", "boleteria",
    "taller", "curso", "conferencia", "exposición", "exposicion", "presentación", "presentacion", "gira", "tour", "fiesta", "campeonato", "torneo",
    "maratón", "maraton", "desfile", "carnaval", "agenda", "te esperamos", "no te lo pierdas", "próximamente", "proximamente", "inscripciones", "cupos",
    "en vivo", "invitamos",
)
NO_IMAGE = ("emoji.php", "rsrc.php", "static.xx.fbcdn.net", "/images/emoji")


def any_of(parts: tuple[str, ...]) -> str:
    """A pattern for any of some texts, within words too."""
    return "|".join(p.replace(".", r"\.") for p in parts)


def hints_at_event(text: Column) -> Column:
    """Whether a post has any of the words that make it worth a closer look."""
    return F.lower(F.coalesce(text, F.lit(""))).rlike(any_of(HINTS))


def image(url: Column) -> Column:
    """An image's address, null for one that shows an emoji or a part of the interface, and for anything but the web."""
    neat = F.trim(url)
    return F.when(neat.rlike("^https?://") & ~F.lower(neat).rlike(any_of(NO_IMAGE)), neat)


def without_noise(parts: Column, source_name: Column) -> Column:
    """The parts of a post as lines, without labels, counters, the source's own name, and lines that were there before regardless of case."""
    neat = F.transform(parts, lambda p: F.regexp_replace(F.regexp_replace(F.coalesce(p, F.lit("")), r"[ \t]+", " "), r"(?U)^\s+|\s+$", ""))
    name = F.lower(F.trim(F.coalesce(source_name, F.lit(""))))
    keyed = F.transform(neat, lambda t: F.struct(t.alias("t"), F.regexp_replace(F.lower(t), r"^[ .:\-]+|[ .:\-]+$", "").alias("k")))
    sound = F.filter(
        keyed,
        lambda x: (x["t"] != "") & ~x["k"].isin(*INTERFACE) & ((name == "") | (x["k"] != name)) & ((F.length(x["t"]) > 3) | x["t"].rlike(r"(?U)\p{L}")) & ~x["t"].rlike(r"^\d+[KkMm]?$"),
    )
    once = F.filter(sound, lambda x, i: ~F.exists(F.slice(sound, F.lit(1), i), lambda y: y["k"] == x["k"]))
    return F.array_join(F.transform(once, lambda x: x["t"]), "\n")


def of_sources(sources: DataFrame, ids: list[str] | None = None, kind: str | None = None) -> DataFrame:
    """The sources with some ids, or of a type; all where neither is asked for."""
    out = sources if ids is None else sources.where(F.col("id").isin(*ids))
    return out if kind is None else out.where(F.col("type") == kind)


def results_of(results: DataFrame, sources: DataFrame) -> DataFrame:
    """The results of some sources."""
    return results.join(sources.select(F.col("id").alias("source_id")), "source_id", "left_semi")
