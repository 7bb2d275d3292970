"""Template residue and error-page text: near-duplicates of trusted residue, found by partitioned SimHash tables.

Every text is cut into units of three kinds: its sentences, lines and clauses; its *fragments*, runs in signs that prose
doesn't use (``{{...}}``, ``<...>``, ``__...__``) and runs of filler words; and, where it is short, the field as a whole.
A unit without its numbers, names, tags and repetitions is a skeleton, and equal skeletons are one node. About eighty
trusted texts, one of each kind of residue, are the only labels there are: no pattern decides about a text. From them
labels spread. Each skeleton gets a 64-bit SimHash of its character 4-grams; eight blocks of eight bits make 28 tables,
keyed by two blocks each. Pairs with a labelled end that meet in a table are verified by Hamming distance, then by
Jaccard similarity, and the label moves on until no component that holds a trusted text grows any more. SimHash alone
loses pairs of the wanted similarity, so a prefix filter finds the rest of them: in one order of all 4-grams, rare ones
first, two texts of Jaccard similarity 0.8 or more share one of their first grams. A sentence with a placeholder in it
isn't labelled itself, since the nearest text to it is the real sentence; its fragment is.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.runtime import cut, join_counted, map_rows, small

FIELDS = ("description", "provenance")
SIMILARITY = 0.8
#: Pairs within six bits are sure to meet in a table; those up to HAMMING are verified too where they meet. All others of
#: the wanted similarity meet by the prefix filter.
SURE, HAMMING = 6, 12
BLOCKS, KEYED = 8, 2
#: Largest frontier (labelled skeletons of a round) that is broadcast; a larger one is joined by shuffle.
FRONTIER_ROWS = 20_000
#: Largest result that is broadcast back to the units.
RESULT_ROWS = 500_000
#: Longest field that is a unit as a whole.
SHORT_FIELD = 60

# Fixed values from here on: trusted residue, one text of a kind, in the words that servers, programs and templates use.
#: Sentences of error pages, notices and programs.
SENTENCES = (
    "Error 404", "HTTP 404", "Erreur 404 : page introuvable", "Fehler 404", "Seite nicht gefunden", "404 Not Found.", "页面不存在，请返回首页。", "错误代码 404",
    "The page you requested could not be located on this server.", "This object page has moved or was deleted.", "Bad gateway nginx", "Internal server error (trace 1)",
    "service temporarily unavailable, try again later.", "request refused by upstream gateway", "HTTP 403 – request refused by upstream gateway", "Access denied.",
    "Access denied. Reference no. 1.", "Reference no. 1.", "The session has expired.", "Log in again to see this record.", "Too many requests from your address.",
    "Please slow down.", "Something went wrong.", "Oops!", "Return to the home page.", "Contact the web team, ext. 1.", "Home > Collections > Object.", "Cannot GET /objects/1",
    "Verify you are human to continue.", "Checking your browser before access.", "We use cookies.", "Accept all to read the full entry.",
    "Please enable JavaScript to view this page.", "You need to enable JavaScript to run this app.", "JavaScript is required to display object details.",
    "This site works best with scripts turned on", "activate them in your browser settings.", "Your browser is not supported.", "Update it to continue.",
    "Loading…", "if nothing appears, allow scripts for this domain.", "Bitte aktivieren Sie JavaScript, um diese Seite anzuzeigen.",
    "Activez JavaScript pour consulter cette fiche.", "请启用 JavaScript 后查看本页内容。", "Traceback (most recent call last)", "KeyError: 'title'",
    "mysql_fetch() expects parameter 1 in /srv/app/item.php on line 1", '{"error": "timeout", "id": 1}', "function () { return desc; }", "[object Object]",
    "此处填写说明文字", "Placeholder – curator to supply wording", "Enter a short note here", "Your text here", "Text goes here.", "DO NOT PUBLISH test entry 1", "write entry",
)
#: Placeholders, tags and filler, as they stand inside wording.
FRAGMENTS = (
    "{{title}}", "${title}", "{title}", "<% title %>", "<%= title %>", "<title>", "</title>", "[[title]]", "[insert title]", "__title__", "%title%", "%(title)s", "@@title@@",
    "&lt;title&gt;", "&lt;/title&gt;", "lorem ipsum dolor sit amet",
)
#: Fields that hold nothing but what a program or a person left there.
FIELDS_AS_WHOLE = ("null", "undefined", "None", "NaN", "#REF!", "#N/A", "#VALUE!", "asdf", "xxx", "tbd", "TODO", "test", "sample text", "Blindtext")
#: Words of the usual filler text, but for those that are words of other languages too.
FILLER = (
    "lorem", "ipsum", "dolor", "sit", "amet", "consectetur", "adipiscing", "elit", "sed", "eiusmod", "tempor", "incididunt", "labore", "dolore", "magna", "aliqua", "nec",
    "quam", "orci", "nunc", "urna", "vitae", "morbi", "fusce", "rutrum", "dapibus", "porttitor", "pellentesque", "mattis",
)
# End of the fixed values.

_INNER = r"[\p{L}_][\p{L}\p{N}_.]*(?: [\p{L}_][\p{L}\p{N}_.]*){0,4}"
#: Runs in signs that prose doesn't use.
_FRAGMENT = (
    rf"\{{\{{ ?{_INNER} ?\}}\}}|\$?\{{ ?{_INNER} ?\}}|<%=? ?{_INNER} ?%>|</?{_INNER}(?: [^<>]{{0,80}})?/?>|\[\[ ?{_INNER} ?\]\]|\[ ?{_INNER} ?\]"
    rf"|__ ?{_INNER}?__|%\({_INNER}\)s|%{_INNER}%|@@ ?{_INNER} ?@@|&lt;/?{_INNER}&gt;"
)
#: Three filler words at least; between two of them one word may stand that isn't in the list.
_FILLER_RUN = rf"(?i)\b(?:{'|'.join(FILLER)})\b(?:[\s,.]+(?:\w+[\s,.]+)?(?:{'|'.join(FILLER)})\b){{2,}}"


#: Signs that a unit may stand in.
_OUTER = " \t\u00a0\u3000[]()\"'*"


def segments(text: Column) -> Column:
    """Sentences, lines, list items and clauses after a colon, as an array."""
    return F.split(text, r"(?<=[.!?…])[\s 　]+|(?<=[。！？])|[\r\n]+|;\s+|(?<=[A-Za-z)\d]):\s+")


def skeleton(unit: Column, whole: bool = False) -> Column:
    """A unit without its tags, numbers, outer signs, and capitalised names inside it; a whole field also without
    repeated words."""
    tagged = unit.contains("<") | unit.contains("&lt;")
    x = F.when(tagged, F.regexp_replace(unit, r"</?\w[^<>]*>|&lt;/?\w+&gt;", " ")).otherwise(unit)
    if whole:
        x = F.regexp_replace(F.regexp_replace(x, r"\bx{3,}\b", "xxx"), r"(?i)\b(\w+(?: \w+)?)\b(?:[\s,;.]+\1\b)+", "$1")
    x = F.btrim(x, F.lit(_OUTER))
    x = F.regexp_replace(x, r"(?<=\S )[A-Z][a-z]+(?:['-][A-Za-z]?[a-z]+)*", "N")
    return F.lower(F.regexp_replace(x, r"[0-9]+", "#"))


def fragment_skeleton(fragment: Column) -> Column:
    """The signs of a fragment and n for what stands in them; in square brackets the first word stays, for editors use
    those too."""
    square = fragment.startswith("[") & ~fragment.startswith("[[")
    inner = F.regexp_replace(fragment, r"[\p{L}\p{N}_.]*[\p{L}\p{N}.](?: [\p{L}\p{N}_.]*[\p{L}\p{N}.])*", "n")
    x = F.when(square, F.regexp_replace(F.lower(fragment), r"(?<=\w )[\w. ]*\w", "n")).otherwise(F.regexp_replace(inner, r"</?n(?: [^<>]*)?/?>", "<n>"))
    return F.regexp_replace(x, r"(?<=\W) n|n (?=\W)", "n")


def units(text: Column) -> Column:
    """Skeletons of all units of a text: sentences behind "s", fragments behind "f", the whole field behind "w"."""
    none = F.array().cast("array<string>")
    sentence = F.transform(segments(text), lambda s: F.concat(F.lit("s "), skeleton(s)))
    signs = F.when(text.rlike(r"[{}<>%\[]|__|@@|&lt;"), F.transform(F.regexp_extract_all(text, F.lit(_FRAGMENT), F.lit(0)), lambda f: F.concat(F.lit("f "), fragment_skeleton(f))))
    filler = F.when(text.rlike(_FILLER_RUN), F.array(F.lit("f lorem ipsum")))
    whole = F.when(F.length(text) <= SHORT_FIELD, F.array(F.concat(F.lit("w "), skeleton(text, True))))
    every = F.concat(sentence, F.coalesce(signs, none), F.coalesce(filler, none), F.coalesce(whole, none))
    return F.array_distinct(F.filter(every, lambda u: F.length(u) > 2))


def trusted(spark: SparkSession) -> DataFrame:
    """(skeleton) of the trusted texts; their number is that of the fixed values."""
    rows = [("s", t) for t in SENTENCES] + [("f", t) for t in FRAGMENTS] + [("w", t) for t in FIELDS_AS_WHOLE]
    text = F.col("text")
    filled = F.when(text.rlike(_FILLER_RUN), "lorem ipsum").when(F.col("kind") == "f", fragment_skeleton(text)).when(F.col("kind") == "w", skeleton(text, True)).otherwise(skeleton(text))
    return spark.createDataFrame(rows, "kind string, text string").select(F.concat_ws(" ", "kind", filled).alias("skeleton")).distinct()


def simhashes(texts: list[str]) -> np.ndarray:
    """64-bit SimHash over the character 4-grams of each text (of its only gram if it is shorter)."""
    raw = [(t if len(t) >= 4 else t.ljust(4)).encode("utf-32-le") for t in texts]
    sizes = np.array([len(r) // 4 - 3 for r in raw])
    flat = np.frombuffer(b"".join(raw), dtype="<u4").astype(np.uint64)
    with np.errstate(over="ignore"):
        g = flat.copy()
        for k in range(1, 4):
            g[:-k] = g[:-k] * np.uint64(1_000_003) + flat[k:]
        starts = np.concatenate(([0], np.cumsum(sizes + 3)[:-1]))
        keep = np.ones(len(flat), bool)
        for k in range(1, 4):
            keep[starts + sizes + 3 - k] = False
        h = g[keep]
        h ^= h >> np.uint64(33)
        h *= np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(33)
        h *= np.uint64(0xC4CEB9FE1A85EC53)
        h ^= h >> np.uint64(33)
    out = np.empty(len(texts), np.uint64)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(texts):  # as many texts at a time as keep the bits small
        begin = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, begin + 200_000, "right")))
        part = h[begin : ends[to - 1]]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int32)
        sums = np.add.reduceat(bits, np.concatenate(([0], ends[at : to - 1] - begin)), axis=0)
        out[at:to] = np.packbits(sums * 2 > sizes[at:to, None], axis=1, bitorder="little").view("<u8").ravel()
        at = to
    return out


def _grams(text: str) -> set[str]:
    return {text[i : i + 4] for i in range(max(1, len(text) - 3))}


def jaccard(a: str, b: str) -> float:
    x, y = _grams(a), _grams(b)
    return len(x & y) / len(x | y)


def _bucket(gram: str) -> int:
    return zlib.crc32(gram.encode("utf-32-le", "surrogatepass")) & 0xFFFF


def gram_counts(skeletons: DataFrame) -> dict[int, int]:
    """How often the grams of each of 65,536 buckets occur in skeletons(skeleton), all of which are counted. They order the
    grams, rare ones first."""

    def make() -> Callable[..., Iterable[tuple]]:
        known: dict[str, int] = {}

        def bucket(g: str) -> int:
            if g not in known:
                if len(known) > 200_000:
                    known.clear()
                known[g] = _bucket(g)
            return known[g]

        def step(texts: list) -> Iterable[tuple]:
            grams = Counter(g for t in texts for g in _grams(t))
            totals: Counter[int] = Counter()
            for g, n in grams.items():
                totals[bucket(g)] += n
            yield from totals.items()

        return step

    counts = map_rows(skeletons.select("skeleton"), make, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    return {r.bucket: r.n for r in counts.collect()}  # 65,536 rows at most


def prefix(text: str, order: Callable[[str], tuple]) -> tuple[int, list[str]]:
    """(number of grams, the first of them in the order): two texts that are similar enough share one of the first."""
    grams = _grams(text)
    n = len(grams)
    return n, sorted(grams, key=order)[: n - math.ceil(SIMILARITY * n - 1e-9) + 1]


def _prepared(skeletons: DataFrame, counts: dict[int, int]) -> DataFrame:
    """skeletons(h, skeleton, label) with the SimHash, the number of grams and the keys of the prefix of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[int, str]] = {}

        def order(g: str) -> tuple[int, str]:
            if g not in known:
                if len(known) > 200_000:
                    known.clear()
                known[g] = counts.get(_bucket(g), 0), g
            return known[g]

        for b in batches:
            texts = b.column(1).to_pylist()
            if not texts:
                continue
            ns, firsts = [], []
            for t in texts:
                n, first = prefix(t, order)
                ns.append(n)
                firsts.append([xxhash.xxh64_intdigest(g.encode("utf-8", "surrogatepass")) - (1 << 63) for g in first])
            columns = [*b.columns, pa.array(simhashes(texts).astype(np.int64)), pa.array(ns, pa.int32()), pa.array(firsts, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["h", "skeleton", "label", "hash", "n", "prefix"])

    return skeletons.select("h", "skeleton", "label").mapInArrow(run, "h long, skeleton string, label boolean, hash long, n int, prefix array<long>")


def _keys(column: str) -> Column:
    """The 28 table keys of a SimHash: table number and two of its eight blocks."""
    masks = [sum(255 << 8 * i for i in chosen) for chosen in combinations(range(BLOCKS), KEYED)]
    signed = F.array(*[F.lit(m - (1 << 64) if m >> 63 else m).cast("long") for m in masks])
    return F.explode(F.transform(signed, lambda m, n: F.xxhash64(F.col(column).bitwiseAND(m), n)))


def label_skeletons(skeletons: DataFrame, rounds: int | None = None) -> DataFrame:
    """(h) of the skeletons that are residue, of skeletons(h, skeleton, label): the trusted ones, then all that hangs
    together with them by pairs of similarity 0.8 or more. ``rounds`` ends the spread early, for tests."""
    every = cut(skeletons)
    spread = cut(_prepared(every, gram_counts(every)))
    frontier = spread.where("label")
    labelled = frontier.select("h")

    def make() -> Callable[..., Iterable[tuple]]:
        def step(h: list, a: list, b: list) -> Iterable[tuple]:
            for i, x, z in zip(h, a, b):
                if jaccard(x, z) >= SIMILARITY:
                    yield (i,)

        return step

    while rounds is None or rounds > 0:
        right = small(frontier, FRONTIER_ROWS).select(F.col("skeleton").alias("near"), F.col("hash").alias("near_hash"), F.col("n").alias("near_n"), "prefix")
        tables = spread.select("h", "skeleton", "hash", _keys("hash").alias("key")).join(right.select("near", "near_hash", _keys("near_hash").alias("key")), "key")
        tables = tables.where(F.bit_count(F.col("hash").bitwiseXOR(F.col("near_hash"))) <= HAMMING)
        first = spread.select("h", "skeleton", "n", F.explode("prefix").alias("key")).join(right.select("near", "near_n", F.explode("prefix").alias("key")), "key")
        first = first.where(f"least(n, near_n) >= {SIMILARITY}D * greatest(n, near_n) - 1e-9D")
        pairs = tables.select("h", "skeleton", "near").unionByName(first.select("h", "skeleton", "near")).distinct()
        new = cut(map_rows(pairs, make, "h long").distinct().join(labelled, "h", "left_anti"))
        if new.isEmpty():
            break
        labelled = cut(labelled.unionByName(new))
        frontier = cut(spread.join(small(new, FRONTIER_ROWS), "h", "left_semi"))
        rounds = None if rounds is None else rounds - 1
    return labelled


def residue(df: DataFrame, key: str = "seq", fields: tuple[str, ...] = FIELDS, rounds: int | None = None) -> DataFrame:
    """One row (key, field_name) per field that holds any residue.

    NULL, empty and blank fields give no rows; repeated rows each give their own; texts of any length are read whole;
    a table without any residue gives no rows; columns that aren't named are ignored. ``rounds`` of 0 leaves only what
    is word for word a trusted text but for numbers and names.
    """
    values = F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).cast("string").alias("text")) for f in fields]))
    long = df.select(F.col(key).alias("key"), values.alias("v")).select("key", "v.field_name", "v.text").where(r"text rlike '\\S'")
    # the texts are cut up once: most of the cost is theirs
    parts = cut(long.select("key", "field_name", F.explode(units(F.col("text"))).alias("skeleton")).withColumn("h", F.xxhash64("skeleton")))
    known = trusted(df.sparkSession).withColumn("label", F.lit(True))
    met = parts.select("h", "skeleton").unionByName(known.select(F.xxhash64("skeleton").alias("h"), "skeleton")).groupBy("h").agg(F.min("skeleton").alias("skeleton"))
    found = cut(label_skeletons(met.join(F.broadcast(known), "skeleton", "left").withColumn("label", F.coalesce("label", F.lit(False))), rounds))
    return join_counted(parts.select("key", "field_name", "h"), found, ["h"], "left_semi", RESULT_ROWS).select(F.col("key").alias(key), "field_name").distinct()
