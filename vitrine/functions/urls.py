"""URL functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitrine.functions.text import c

_SUFFIX = r"(?i)\.(?:jpe?g|png|tiff?|webp)$"


def path_of(x: Column | str) -> Column:
    """The path of a URL, empty for what is no URL."""
    return F.coalesce(F.try_parse_url(c(x), F.lit("PATH")), F.lit(""))


def https(x: Column | str) -> Column:
    return F.regexp_replace(c(x), "^http://", "https://")


def extension(x: Column | str) -> Column:
    """Image suffix of the path, jpg if it has none."""
    found = F.regexp_extract(F.lower(path_of(x)), r"\.(jpg|jpeg|png|tif|tiff|webp|gif)$", 1)
    return F.when(found == "", "jpg").otherwise(found)


def without_param(x: Column | str, name: str) -> Column:
    """The URL without one query parameter."""
    t = F.regexp_replace(c(x), rf"(?i)([?&]){name}=[^&#]*&?", "$1")
    return F.regexp_replace(t, r"[?&]$", "")


def image_key(x: Column | str) -> Column:
    """Key under which renditions of one image meet: the id parameter without suffix, else the URL before its query."""
    ident = F.coalesce(F.try_parse_url(c(x), F.lit("QUERY"), F.lit("id")), F.lit(""))
    return F.when(ident != "", F.regexp_replace(ident, _SUFFIX, "")).otherwise(F.lower(F.substring_index(c(x), "?", 1)))


def image_score(label: Column | str, x: Column | str) -> Column:
    """How good a rendition is: originals and deliverable formats up, thumbnails down."""
    u, n = F.lower(c(x)), F.lower(F.coalesce(c(label), F.lit("")))
    marks = (
        (u.contains("thumb") | n.contains("thumb") | n.contains("small") | u.contains("150"), -70),
        (u.contains("deliver"), 50),
        (n.rlike("high|full|original|large|tiff|master"), 40),
        (u.rlike(r"\.(?:jpe?g|png)$"), 20),
        (u.contains("/download?") & u.contains(".tif"), 5),
    )
    return sum((F.when(m, s).otherwise(0) for m, s in marks), F.lit(0))


def web_images(urls: Column, most: int = 8) -> Column:
    """URLs a browser shows, else the first one; at most ``most``."""
    shown = F.filter(urls, lambda u: F.lower(u).contains("deliver") | u.rlike(r"(?i)\.(?:jpe?g|png|webp)(?:\?|$)"))
    return F.slice(F.when(F.size(shown) > 0, shown).otherwise(F.slice(urls, 1, 1)), 1, most)


def iiif_base(x: Column | str) -> Column:
    t = F.regexp_replace(F.rtrim(c(x)), "/+$", "")
    return F.regexp_replace(F.regexp_replace(t, r"(?i)/full/[^/]+/\d+/default\.(?:jpe?g|png|webp)$", ""), "_dynmc$", "")


def fold_images(urls: Column) -> dict[str, Column]:
    """The five image columns of a record from its list of URLs."""
    return {"image_url": F.coalesce(F.get(urls, F.lit(0)), F.lit("")), "image_urls": F.array_join(urls, " | "), "image_count": F.size(urls).cast("string")}
