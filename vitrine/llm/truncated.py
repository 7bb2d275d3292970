"""Texts cut off by field limits: is the end of the text one at which texts end?

A backward character n-gram model (orders 1 to 6, read from the last character) is trained on every distinct text of a
group (column, language, prose or note). For the last characters of a text it holds two likelihoods against each other:
that a text *ends* after this context, and that it *goes on*; each order backs off to the next shorter one, and a text
never votes for its own end. A text has lost its end where the log-odds of an end stay below the threshold of its
group, which is learned from the group's own texts: whole and cut ones make two heaps of log-odds, and the threshold
stands in the valley between them. Marks that a transfer leaves behind (an ellipsis set by the exporter, a broken character, tag or entity) are
taken off first, so that the model learns from the wording alone; a text that bears one is cut whatever stands before it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.llm.residue import residue
from vitrine.runtime import cut, join_counted, small

FIELDS = ("artist_bio", "artist_wikipedia_summary", "description")
ORDER = 6
#: The short context, whose log-odds are averaged with those of the long one: rare wording before a full stop, or the
#: same cut met several times, misleads only the long one.
SHORT = 2
#: Bits of a character in a packed context.
BITS = 10
#: Strength of the back-off to the next shorter context.
BACKOFF = 20.0
#: Places at which the last character must have been seen before its ends and continuations tell anything.
EVIDENCE = 25
#: Where a group's log-odds show no valley, its threshold is the log-odds of an end at a random place plus this.
MARGIN = 1.1
#: Ends from which a valley can be told.
HEAP_ENDS = 200
#: Longest text without any sentence end that may be a note.
NOTE_CHARS = 90
#: Largest result of the distinct texts that is broadcast back to the rows.
RESULT_ROWS = 500_000

_MARK = re.compile(r"(?:\s*(?:…|\.{3}|\[\s*(?:\.{3}|…)\s*\]?|(?:…|\.{3})?\s*[\[(](?:truncated|more|cut|continued)[^\])]*[\])]?)\s*)$", re.I)
_BROKEN = re.compile(r"(?:�+|&#?\w{0,8}|<\s*/?\w{0,12}(?:\s[^<>]*)?)$")
_END = re.compile(r"[.!?。！？…]")
#: Scripts by a letter of theirs, and frequent words of languages written in Latin letters.
SCRIPTS = {
    1: re.compile(r"[぀-ヿ]"), 2: re.compile(r"[㐀-鿿]"), 3: re.compile(r"[가-힯]"), 4: re.compile(r"[Ѐ-ӿ]"), 5: re.compile(r"[ऀ-ॿ]"), 6: re.compile(r"[฀-๿]"), 7: re.compile(r"[؀-ۿ]"), 8: re.compile(r"[Ͱ-Ͽ]"), 9: re.compile(r"[֐-׿]"),
}
FREQUENT = {
    10: ("der", "die", "das", "und", "ist", "mit", "von", "den", "dem", "ein", "eine", "wurde", "auf", "nicht"),
    11: ("le", "les", "des", "une", "est", "dans", "par", "pour", "sur", "aux", "qui", "cette"),
    12: ("el", "los", "las", "del", "una", "por", "para", "que", "fue", "con", "su"),
    13: ("il", "della", "che", "di", "gli", "nel", "una", "sono", "per"),
    0: ("the", "of", "and", "in", "was", "is", "with", "by", "from", "this", "his", "her", "at", "to", "a", "no"),
}
#: Numbers that a language may have.
LANGUAGES = 16
_ANY = re.compile(r"[^\x00-\x7f]")
_FREQUENT = {w: [k for k, words in FREQUENT.items() if w in words] for words in FREQUENT.values() for w in words}


def language(text: str) -> int:
    """Number of the language a text is in, as its end shows: by script; in Latin letters by frequent words, 0 (English
    and whatever says nothing else) unless two words at least speak for another language and more than for English."""
    tail = text[-200:]
    if _ANY.search(tail[-24:]):
        for k, letters in SCRIPTS.items():
            if letters.search(tail[-24:]):
                return 2 if k == 1 else k
    votes = dict.fromkeys(FREQUENT, 0)
    for w in tail.lower().split():
        for k in _FREQUENT.get(w, ()):
            votes[k] += 1
    best = max(votes, key=votes.get)
    return best if votes[best] >= 2 and votes[best] > votes[0] else 0


def _ends(text: str) -> tuple[str, int]:
    """The wording without transfer marks at its end, and 0 for no mark, 1 for an ellipsis, 2 for broken characters."""
    bare = text.rstrip()
    m = _BROKEN.search(bare)
    if m and m.start() > 0:
        return bare[: m.start()].rstrip(), 2
    m = _MARK.search(bare)
    if m and m.start() > 0:
        return bare[: m.start()].rstrip(), 1
    return bare, 0


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The packed last ORDER characters at every place of every text, and the places at which texts end."""
    pad = "\0" * (ORDER - 1)
    flat = np.frombuffer((pad + pad.join(texts)).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    flat = np.where(flat < 128, flat, 128 + (flat * 2654435761 >> 7) % ((1 << BITS) - 128))
    codes = flat[ORDER - 1 :].copy()
    for k in range(1, ORDER):
        codes |= flat[ORDER - 1 - k : len(flat) - k] << (BITS * k)
    ends = np.cumsum([len(t) + len(pad) for t in texts]) - len(pad) - 1
    return codes[flat[ORDER - 1 :] != 0], codes[ends]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text its group, final context and marks (what = 0); per task the contexts of all places and how often (1)."""
    schema = pa.schema([("what", pa.int32()), ("field", pa.int32()), ("h", pa.int64()), ("g", pa.int32()), ("code", pa.int64()), ("n", pa.int64()), ("mark", pa.int32()), ("head", pa.int64())])
    sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def add(g: int, codes: np.ndarray, n: np.ndarray | None = None) -> None:
        if g in sums:
            codes, n = np.concatenate((sums[g][0], codes)), np.concatenate((sums[g][1], np.ones(len(codes), np.int64) if n is None else n))
        if n is None:
            sums[g] = np.unique(codes, return_counts=True)
        else:
            u, at = np.unique(codes, return_inverse=True)
            sums[g] = u, np.bincount(at, n).astype(np.int64)

    for b in batches:
        fields, hs, texts = (c.to_pylist() for c in b.columns)
        if not fields:
            continue
        bare, marks = zip(*map(_ends, texts))
        groups = [2 * (f * LANGUAGES + language(t)) + (len(t) <= NOTE_CHARS and not _END.search(t)) for f, t in zip(fields, bare)]
        final = np.zeros(len(texts), np.int64)
        for g in set(groups):
            at = [i for i, x in enumerate(groups) if x == g and bare[i]]
            if at:
                codes, ends = _codes([bare[i] for i in at])
                final[at] = ends
                add(g, *np.unique(codes, return_counts=True))
        yield pa.RecordBatch.from_arrays([pa.array(x, type=f.type) for x, f in zip(([0] * len(texts), fields, hs, groups, final, [len(t) for t in texts], marks, [crc32(t[:64].encode("utf-8", "replace")) for t in texts]), schema)], schema=schema)
    for g, (codes, n) in sums.items():
        zero = np.zeros(len(codes), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(x, type=f.type) for x, f in zip((zero + 1, zero, zero, zero + g, codes, n, zero, zero), schema)], schema=schema)


def _levels(df: DataFrame, *keep: str) -> DataFrame:
    """Each context at orders 1 to ORDER (k, c)."""
    ks = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col("code").bitwiseAND((1 << (BITS * k)) - 1).alias("c")) for k in range(1, ORDER + 1)]))
    return df.select("g", *keep, ks.alias("x")).select("g", *keep, "x.k", "x.c")


def _long(df: DataFrame, fields: tuple[str, ...], *keep: Column) -> DataFrame:
    values = F.explode(F.array(*[F.struct(F.lit(i).alias("field"), F.col(f).cast("string").alias("text")) for i, f in enumerate(fields)]))
    return df.select(*keep, values.alias("v")).select(*[c for c in df.select(*keep).columns], "v.field", "v.text").where(r"text rlike '\\S'").withColumn("h", F.xxhash64("field", "text"))


def valley(histogram: list[tuple[float, int]], base: float) -> float:
    """The threshold of a group from its (log-odds, ends), rounded to tenths: the lowest place of the histogram, half a
    unit wide, between the log-odds of a random place (``base``, a unit below it at least) and the heap of whole texts,
    which begins where a quarter of the largest count is reached; of places as low but for chance, the nearest to ``base`` +
    MARGIN. Too few ends, or no heap of cut texts on the left that
    stands out, give ``base`` + MARGIN."""
    fallback = base + MARGIN
    if sum(n for _, n in histogram) < HEAP_ENDS:
        return fallback
    first = min(histogram)[0]
    counts = np.zeros(int(round((max(histogram)[0] - first) * 10)) + 1)
    for v, n in histogram:
        counts[int(round((v - first) * 10))] += n
    smooth = np.convolve(counts, np.ones(5), "same")
    left = max(0, int(round((base - 1 - first) * 10)))
    heap = np.flatnonzero(smooth[left:] >= smooth.max() / 4)
    if not len(heap) or not heap[0]:
        return fallback
    between = smooth[left : left + heap[0]]
    low = left + np.flatnonzero(between <= between.min() + 2 * np.sqrt(between.min()) + 2)
    at = int(low[np.argmin(np.abs(first + low / 10 - fallback))])
    if smooth[:at].max(initial=0) < 2 * between.min() + 5:
        return fallback
    return first + at / 10


def end_odds(df: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """Per distinct text (field, h): group g, log-odds of an end after its last characters, threshold of the group, mark
    and length; no odds where the group has too little text to tell. Empty input gives an empty table."""
    distinct = _long(df, fields).groupBy("field", "h").agg(F.first("text").alias("text"))
    every = cut(distinct.select("field", "h", "text").mapInArrow(_count, "what int, field int, h long, g int, code long, n long, mark int, head long"))
    texts = every.where("what = 0")
    places = every.where("what = 1").groupBy("g", "code").agg(F.sum("n").alias("n"))
    # the same text cut at the same place in several ways is one end
    ends = texts.select("g", "code", "head").distinct().groupBy("g", "code").agg(F.count("*").alias("e"))
    contexts = cut(ends)
    base = small(ends.groupBy("g").agg(F.sum("e").alias("e")).join(places.groupBy("g").agg(F.sum("n").alias("n")), "g").select("g", (F.col("e") / F.col("n")).alias("base")), 1000)
    by_end = _levels(contexts, "e").groupBy("g", "k", "c").agg(F.sum("e").alias("e"))
    by_place = _levels(places, "n").groupBy("g", "k", "c").agg(F.sum("n").alias("n"))
    known = by_end.join(by_place, ["g", "k", "c"])
    steps = _levels(contexts, "code").join(known, ["g", "k", "c"]).groupBy("g", "code").agg(F.array_sort(F.collect_list(F.struct("k", "e", "n"))).alias("steps")).join(base, "g")
    step = lambda p, x: (x["e"] - 1 + p * BACKOFF) / (F.greatest(x["n"], x["e"]) - 1 + BACKOFF)

    def log_odds(orders: int) -> Column:
        rate = F.greatest(F.least(F.aggregate(F.slice("steps", 1, orders), F.col("base"), step), F.lit(0.999)), F.lit(1e-9))
        return F.log(rate / (1 - rate))

    both = (log_odds(SHORT) + log_odds(ORDER)) / 2
    odds = cut(steps.where(F.col("steps")[0]["n"] >= EVIDENCE).select("g", "code", both.alias("odds"), F.log(F.col("base") / (1 - F.col("base"))).alias("random")))
    # a histogram of the log-odds: some hundred bins for each of the few groups
    bins = odds.join(contexts, ["g", "code"]).groupBy("g", F.round("odds", 1).alias("at")).agg(F.sum("e").alias("e"), F.min("random").alias("random"))
    groups: dict[int, list] = {}
    for r in bins.collect():
        groups.setdefault(r.g, []).append((r["at"], r.e, r.random))
    learned = [(g, valley([(v, n) for v, n, _ in rows], rows[0][2])) for g, rows in groups.items()]
    thresholds = df.sparkSession.createDataFrame(learned, "g int, threshold double")
    return texts.select("field", "h", "g", "code", "mark", F.col("n").alias("chars")).join(odds.drop("random"), ["g", "code"], "left").join(F.broadcast(thresholds), "g", "left")


def cut_off(df: DataFrame, key: str = "seq", fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """One row (key, field_name) per field that lost its end.

    NULL, empty and blank fields give no rows; notes that are no sentences by design and texts of page or template
    matter don't count; every copy of a cut text is reported; texts of any length are read whole; columns that aren't
    named are ignored.
    """
    scored = end_odds(df, fields)
    lost = cut(scored.where((F.col("mark") > 0) | (F.col("odds") < F.col("threshold"))).select("field", "h"))
    # page and template matter is another operator's case: its labels are spread over the wordings in question
    rows = _long(df, fields, F.col(key).alias("key"))
    rows = join_counted(rows, lost, ["field", "h"], "left_semi", RESULT_ROWS)
    texts = cut(rows.groupBy("field", "h").agg(F.first("text").alias("text")))
    matter = residue(texts.withColumn("id", F.struct("field", "h")), "id", ("text",)).select("id.field", "id.h")
    kept = join_counted(rows, cut(lost.join(matter, ["field", "h"], "left_anti")), ["field", "h"], "left_semi", RESULT_ROWS)
    return kept.select(F.col("key").alias(key), F.element_at(F.array(*map(F.lit, fields)), F.col("field") + 1).alias("field_name"))


def rates(df: DataFrame, key: str = "seq", source: str = "museum_id", fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """Per source and field: texts, texts that lost their end, and their share."""
    tagged = df.select(F.struct(F.col(key).alias("key"), F.col(source).alias("source")).alias("row"), *fields)
    lost = cut_off(tagged, "row", fields).groupBy(F.col("row.source").alias(source), "field_name").agg(F.count("*").alias("cut_off"))
    texts = df.groupBy(source).agg(*[F.count_if(F.col(f).rlike(r"\S")).alias(f) for f in fields]).unpivot([source], list(fields), "field_name", "texts")
    full = texts.join(lost, (texts[source].eqNullSafe(lost[source])) & (texts.field_name == lost.field_name), "left")
    n = F.coalesce("cut_off", F.lit(0))
    return full.select(texts[source], texts.field_name, "texts", n.alias("cut_off"), F.round(F.try_divide(n, F.col("texts")), 6).alias("share"))
