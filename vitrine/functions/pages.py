"""Texts of object pages, line by line, and the addresses they hold, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitrine.functions.text import c, let, strip
from vitrine.functions.urls import iiif_base

# Fixed values from here on.
#: Lines of a page's own controls.
CONTROLS = (
    "×", "✓", "choose collection", "create new collection", "copy link", "thanks for sharing!", "find any service", "addtoany", "more…", "more...", "share", "add to any",
)
#: Headers of a page's sections.
HEADERS = (
    "Provenance", "Publication History", "Credit Line", "Accession", "Classification", "Medium", "Dimension", "Dimensions", "Date", "Culture", "Country", "Artist", "Maker",
    "Creator", "Bibliography", "Collection", "Collections", "Exhibition History", "Label", "Department", "Description", "Object", "Objects",
)
#: Renditions asked of an image service, and services whose addresses say what they are.
RENDITIONS = ("/full/!800,800/0/default.jpg", "/full/full/0/default.jpg")
IMAGE_SERVICE, REDIRECT_SERVICE = "ids.lib.harvard.edu/mps/", "nrs.harvard.edu"
#: Where a media dispatcher keeps its files.
DISPATCHER = "/internal/media/dispatcher/"
# End of the fixed values.

_LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85  ]"


def lines(x: Column | str) -> Column:
    """Stripped lines of a text, blank ones as empty strings."""
    return F.transform(F.split(F.coalesce(c(x), F.lit("")), _LINE_END), strip)


def is_control(line: Column) -> Column:
    return F.lower(line).isin(*CONTROLS)


def field_value(x: Column | str, most: int = 2000, joint: str = " ") -> Column:
    """A text without blank lines and lines of a page's controls, cut to ``most`` characters, the last an ellipsis."""
    kept = F.array_join(F.filter(lines(x), lambda t: (t != "") & ~is_control(t)), joint)
    return let(kept, lambda t: F.when(F.length(t) > most, F.concat(F.substring(t, 1, most - 1), F.lit("…"))).otherwise(t))


def section(x: Column | str, header: str, most: int = 10) -> Column:
    """The lines under a header, up to the next header or the blank line that ends them, ``most`` at most, as a value.

    Found by positions: the first header line; the first line with wording behind it; then the earliest stop.
    """
    bare = lambda t: F.lower(F.regexp_replace(t, r"\s*:?\s*$", ""))
    named, stops = F.lit(header.lower()), [h.lower() for h in HEADERS]

    def read(every: Column) -> Column:
        shown = F.filter(every, lambda t: ~is_control(t))
        return let(shown, from_header)

    def from_header(shown: Column) -> Column:
        at = F.array_position(F.transform(shown, bare), named)
        return F.when(at == 0, "").otherwise(let(F.slice(shown, at.cast("int") + 1, F.size(shown)), body))

    def body(rest: Column) -> Column:
        # repeated headers say nothing new; blank lines before the wording don't end it
        rest = F.filter(rest, lambda t: bare(t) != named)
        wording = F.array_position(F.transform(rest, lambda t: t != ""), True)
        stop = F.array_position(F.transform(rest, lambda t, i: ((t == "") & (i + 1 > wording) & (wording > 0)) | bare(t).isin(*stops)), True)
        count = F.when(stop > 0, stop - 1).otherwise(F.size(rest))
        kept = F.filter(F.slice(rest, 1, count.cast("int")), lambda t: t != "")
        return field_value(F.array_join(F.slice(kept, 1, most), "\n"))

    return let(lines(x), read)


def page_key(x: Column | str) -> Column:
    """A page's address without parameters, session parts and closing slashes."""
    return F.regexp_replace(F.regexp_replace(strip(x), "[;?].*$", ""), "/+$", "")


def number_in_address(x: Column | str) -> Column:
    return F.regexp_extract(F.coalesce(c(x), F.lit("")), r"/objects/(\d+)(?:/|$)", 1)


def media_number(x: Column | str) -> Column:
    """The number of a dispatcher's preview, empty for other addresses."""
    return F.regexp_extract(F.coalesce(c(x), F.lit("")), rf"(?i){DISPATCHER}(\d+)/preview", 1)


def image_variants(x: Column | str, base: str) -> Column:
    """The address, made absolute, and for a dispatcher's preview the full rendition behind it."""
    u = strip(x)
    whole = F.when(u.rlike(r"^[a-zA-Z][\w+.-]*:"), u).when(u.startswith("//"), F.concat(F.lit("https:"), u)).when(u.startswith("/"), F.concat(F.lit(base), u)).otherwise(F.concat(F.lit(base + "/"), u))
    full = F.when(media_number(u) != "", F.concat(F.lit(base + DISPATCHER), media_number(u), F.lit("/full")))
    return F.when(u == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.array_compact(F.array(whole, full))))


def ordered_images(urls: Column, base: str) -> Column:
    """Direct addresses in their order, then one preview a medium by its number, its full rendition first; what was in
    the list as it stands comes no second time."""
    given = F.array_distinct(F.filter(F.transform(urls, strip), lambda u: u != ""))
    numbers = F.array_sort(F.array_distinct(F.filter(F.transform(given, media_number), lambda n: n != "")))
    full = F.transform(numbers, lambda n: F.concat(F.lit(base + DISPATCHER), n, F.lit("/full")))
    return let(given, lambda g: F.concat(F.filter(g, lambda u: media_number(u) == ""), F.array_except(full, g)))


def iiif_variants(x: Column | str) -> Column:
    """Renditions of an image service's base; an address that names a file or a rendition is its only one."""
    u = F.regexp_replace(strip(x), "/+$", "")
    bases = F.array_distinct(F.array(u, F.regexp_replace(u, "_dynmc$", "")))
    every = F.flatten(F.transform(bases, lambda b: F.array(*[F.concat(b, F.lit(r)) for r in RENDITIONS])))
    none = F.array().cast("array<string>")
    return F.when(~u.startswith("http"), none).when(u.rlike(r"(?i)\.(?:jpe?g|png|webp)(?:\?|$)|/full/"), F.array(u)).otherwise(every)


def iiif_manifest(manifests: Column, bases: Column, image: Column | str) -> Column:
    """Where a record's images are described: a manifest the source names, else what the service of an image's base or
    of the main image keeps, else empty. ``manifests`` and ``bases`` are arrays over the record's images."""
    named = F.get(F.filter(F.transform(manifests, strip), lambda m: m.startswith("http")), F.lit(0))

    def of_base(u: Column) -> Column:
        b = F.regexp_replace(u, "/+$", "")
        return F.when(b.contains(IMAGE_SERVICE), F.concat(b, F.lit("/info.json"))).when(b.contains(REDIRECT_SERVICE), F.concat(F.regexp_replace(b, "_dynmc$", ""), F.lit("/manifest")))

    known = F.get(F.filter(F.transform(F.filter(F.transform(bases, strip), lambda b: b.startswith("http")), of_base), lambda m: m.isNotNull()), F.lit(0))

    def of_image(u: Column) -> Column:
        service = F.when(u.contains(IMAGE_SERVICE), F.concat(u, F.lit("/info.json")))
        other = u.contains(REDIRECT_SERVICE) | F.lower(u).contains("iiif")
        return F.when(~u.startswith("http"), "").otherwise(F.coalesce(service, F.when(other, F.concat(u, F.lit("/manifest"))), F.lit("")))

    return F.coalesce(named, known, let(iiif_base(strip(image)), of_image))
