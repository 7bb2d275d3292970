"""Text functions as column expressions: keys, slugs, lists, names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode white space, punctuation that a key drops, and texts that mean nothing.
_WHITE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_DROPPED = r"[，,。.;；:：!！?？\"'()（）\[\]{}]"
_NOTHING = ("none", "null", "nan")
#: How an attribution may begin, and what institutions and dealers are called.
_ATTRIBUTION = r"(?i)^(?:(?:traditionally\s+)?(?:attributed|formerly\s+attributed|possibly|probably)\s+to|style\s+of|circle\s+of|workshop\s+of|follower\s+of|copy\s+of|after|before)\s*:?\s*"
_BRACKET = r"(?i)\s*\((?:Chinese|Sino-Tibetan|active|born|after)[^)]*\)\s*"
#: Collectors and dealers by name, and one by pattern.
COLLECTORS = (
    "Freer, Charles Lang", "Charles Lang Freer", "Yamanaka and Co.", "You, Xiaoxi", "Li, Wenqing", "Bahr, Abel William", "Sai, Loon Gu", "Lai-Yuan & Company",
    "C. T. Loo & Company", "Riu Cheng Chai", "Meyer, Agnes E.", "Meyer, Eugene and Agnes E.", "Meyer, Eugene I.", "Graham, Katharine Meyer", "Matsuki, Bunkio",
    "Karlbeck, Orvar", "Duanfang", "Amoy Lace Guild", "Cox, John Hadley", "Abe, S.", "Ge Shang, Ta", "Ge Chung, Ta", "buddha",
)
_COLLECTOR = r"(?i)^freer(?:\s*,\s*charles\s+lang|\s+gallery)?\b|charles\s+lang\s+freer"
_INSTITUTION = r"(?i)(?:&\s*co\.?|company|guild|gallery|museum|dealer|foundation|trust)\b"


def c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def let(x: Column, body: Callable[[Column], Column]) -> Column:
    """body of x, with x evaluated once however often body uses it; without this, nested expressions multiply."""
    return F.get(F.transform(F.array(x), body), F.lit(0))


def strip(x: Column | str) -> Column:
    """Without Unicode white space at the ends; NULL as empty."""
    return F.btrim(F.coalesce(c(x).cast("string"), F.lit("")), F.lit(_WHITE))


def squeeze(x: Column | str) -> Column:
    return F.regexp_replace(strip(x), r"(?U)\s+", " ")


def value(x: Column | str) -> Column:
    """Stripped; empty for texts that only say there is none."""
    return let(strip(x), lambda t: F.when(F.lower(t).isin(*_NOTHING), "").otherwise(t))


def norm_key(x: Column | str) -> Column:
    """Key under which spellings of an entity meet. What dropping punctuation leaves at the end isn't trimmed again."""
    return F.regexp_replace(F.lower(squeeze(x)), _DROPPED, "")


def slug(x: Column | str) -> Column:
    """Latin letters, digits and Chinese characters of a key, the rest as single hyphens; "unknown" for none."""
    t = F.regexp_replace(norm_key(x), "[^a-z0-9一-鿿]+", "-")
    return F.coalesce(F.nullif(F.btrim(t, F.lit("-")), F.lit("")), F.lit("unknown"))


def entity_uri(base: str, x: Column | str) -> Column:
    """Colons become slashes, everything but unreserved characters and slashes is percent-encoded."""
    path = F.url_encode(F.regexp_replace(c(x), ":", "/"))
    for a, b in (("%2F", "/"), (r"\+", "%20"), (r"\*", "%2A"), ("%7E", "~")):
        path = F.regexp_replace(path, a, b)
    return F.concat(F.lit(base.rstrip("/") + "/"), path)


def artist_key(x: Column | str) -> Column:
    return F.substring(F.lower(squeeze(x)), 1, 400)


def _parts(x: Column, pattern: str) -> Column:
    return F.filter(F.transform(F.split(strip(x), pattern), lambda p: strip(p)), lambda p: p != "")


def split_artists(x: Column | str) -> Column:
    """Names at semicolons, commas, ideographic commas, " and ", ampersands and slashes."""
    return _parts(c(x), r"(?i)\s*(?:;|,|、| and |&|/)\s*")


def artist_segments(x: Column | str) -> Column:
    """As split_artists but commas stay inside a name; each is cut to 200 characters."""
    return F.transform(_parts(c(x), r"(?i)\s*(?:;|、|/|\band\b)\s*"), lambda p: F.substring(p, 1, 200))


def split_cultures(x: Column | str, most: int = 12) -> Column:
    """Values at semicolons, or else at " / ", first of each key, keys of two characters at least."""
    parts = let(strip(x), lambda t: F.when(t.contains(";"), F.split(t, ";")).otherwise(F.split(t, " / ")))
    kept = F.filter(F.transform(parts, lambda p: F.struct(strip(p).alias("v"), norm_key(p).alias("k"))), lambda s: F.length(s["k"]) >= 2)
    first = F.aggregate(kept, F.array().cast("array<struct<v:string,k:string>>"), lambda a, s: F.when(F.exists(a, lambda y: y["k"] == s["k"]), a).otherwise(F.concat(a, F.array(s))))
    return F.slice(F.transform(first, lambda s: s["v"]), 1, most)


def is_dealer(x: Column | str, known: tuple[str, ...] = COLLECTORS) -> Column:
    """Is a segment a collector, dealer or institution (or nothing) and no maker? ``known`` lists their names."""
    t = strip(x)
    listed = artist_key(t).isin(*[" ".join(k.split()).lower() for k in known]) if known else F.lit(False)
    return (F.length(t) < 2) | t.rlike(_INSTITUTION) | t.rlike(_COLLECTOR) | listed


def segment_priority(x: Column | str) -> Column:
    """How much a segment looks like a maker's name."""
    t = c(x)
    points = ((r"[一-鿿]", 12), (r"[A-Za-z]{2,}", 4), (r",\s*[A-Za-z]", 2), (r"(?s)^.{8,}$", 1))
    return sum((F.when(t.rlike(p), n).otherwise(0) for p, n in points), F.lit(0))


def without_attribution(x: Column | str) -> Column:
    return F.substring(strip(F.regexp_replace(strip(x), _ATTRIBUTION, "")), 1, 200)


def without_brackets(x: Column | str) -> Column:
    return F.substring(squeeze(F.regexp_replace(strip(x), _BRACKET, " ")), 1, 200)


def lookup_name(x: Column | str, known: tuple[str, ...] = COLLECTORS) -> Column:
    """The segment of an artist field to look up: most like a maker, earliest of equals; empty if all are dealers."""
    good = F.filter(artist_segments(x), lambda s: ~is_dealer(s, known))
    ranked = F.transform(good, lambda s, i: F.struct(segment_priority(s).alias("p"), (-i).alias("i"), s.alias("s")))
    return without_attribution(F.coalesce(F.array_max(ranked)["s"], F.lit("")))


def lookup_variants(x: Column | str) -> Column:
    """Up to six distinct ways to search a name: as it is, without prefix and brackets, runs of Chinese characters."""
    base = without_attribution(x)
    forms = F.array(strip(x), base, without_brackets(base), without_brackets(x))
    every = F.concat(F.filter(forms, lambda f: F.length(f) >= 2), F.regexp_extract_all(c(x), F.lit("([一-鿿]{2,12})"), 1))
    return F.slice(F.array_distinct(every), 1, 6)


def merge_texts(parts: list[Column], title: Column, most: int = 8000) -> Column:
    """Distinct parts that say something other than the title, joined by spaces."""
    kept = F.array_distinct(F.filter(F.array(*[value(p) for p in parts]), lambda p: (p != "") & (p != title)))
    return F.substring(F.array_join(kept, " "), 1, most)


def join_list(x: Column) -> Column:
    return F.array_join(F.filter(F.transform(x, lambda p: strip(p)), lambda p: p != ""), "; ")


def split_paths(x: Column | str) -> Column:
    return _parts(c(x), r"\|")


def safe_fragment(x: Column | str, most: int = 160) -> Column:
    return F.substring(F.regexp_replace(c(x), r'(?U)[<>:"/\\|?*\s\x00-\x1f]', "_"), 1, most)


def shorten(x: Column | str, most: int = 3900) -> Column:
    """Cut to ``most`` characters, the last of them an ellipsis."""
    return let(strip(x), lambda t: F.when(F.length(t) > most, F.concat(F.regexp_replace(F.substring(t, 1, most - 1), r"(?U)\s+$", ""), F.lit("…"))).otherwise(t))


def strip_html(x: Column | str) -> Column:
    """Entities first, then tags, then white space."""
    t = F.coalesce(c(x), F.lit(""))
    for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;|&apos;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        t = F.regexp_replace(t, a, b)
    t = F.regexp_replace(F.regexp_replace(t, r"(?i)<br\s*/?>", "\n"), "<[^>]+>", "")
    return squeeze(t)


def publications(x: Column, most: int = 12000) -> Column:
    """array<struct<citation, pagenumbers>> as one text: pages added where the citation hasn't them, distinct, " | "."""
    def line(p: Column) -> Column:
        both = F.struct(strip_html(p["citation"]).alias("c"), strip(p["pagenumbers"]).alias("p"))
        return let(both, lambda b: F.when((b["p"] != "") & ~F.contains(F.lower(b["c"]), F.lower(b["p"])), F.trim(F.concat(b["c"], F.lit(" "), b["p"]))).otherwise(b["c"]))

    return F.substring(F.array_join(F.array_distinct(F.filter(F.transform(F.coalesce(x, F.array()), line), lambda s: s != "")), " | "), 1, most)


def zh_of_era(x: Column | str, prefixes: dict[str, str]) -> Column:
    """What stands in full-width brackets, else the Chinese name of the longest English prefix, else the text."""

    def read(t: Column) -> Column:
        inside = strip(F.regexp_extract(t, "（([^）]+)）", 1))
        out = F.when(inside != "", inside)
        for en, zh in sorted(prefixes.items(), key=lambda p: -len(p[0])):
            out = out.when(t.startswith(en), zh)
        return out.otherwise(t)

    return let(strip(x), read)
