"""Free-entered values mapped to a canonical list by a prefix-filter set-similarity join.

Tokens of a value are the letters and the padded letter pairs of its words, numbered when they repeat, so that a set
holds them and the order of words doesn't matter. Tokens are ordered by global rarity over all distinct values; only
the rare prefix of each side is joined; length and positional filters prune; Jaccard is verified exactly. The best
candidates are then held against the value by edit distance, which decides the entry or "unmatched" (0).
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterable
from functools import lru_cache

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.runtime import cut, join_counted, map_rows, small

#: Jaccard from which a pair is a candidate.
JACCARD = 0.4
#: Entries this close to the most similar one are told apart by edit distance.
CLOSE = 0.2
#: Most tokens and entries of the lists that are sent to every task; larger lists are joined by shuffle.
RANK_ROWS = 200_000
#: Largest table of distinct values that is broadcast back to the rows.
VALUE_ROWS = 200_000
#: Words that say how sure a cataloguer was, or nothing at all.
_DOUBT = r"^(?:prob\.|probably|possibly|perhaps|attributed to|attr\.|object:|type:|material:|the)\s+"
_AFTER = r"(?:\s*,?\s*(?:probably|possibly|attributed|attr\.)|\s*\[[^\]]*\]|\s*\(\?\)|\s*\?|\s+-\s+.*|\s*/|(?<=[\p{L})])\.)$"
#: Words of a period that tell nothing of which.
_ERA = ("dynasty", "dynasties", "period", "era", "dyn", "epoch")


def plain(col: Column) -> Column:
    """Lower case, one space between words, no marks of doubt, no repetition ("x; x"), no era suffix in Chinese."""
    c = F.lower(F.regexp_replace(col.cast("string"), r"[\s 　]+", " "))
    c = F.trim(c)
    for _ in range(2):
        c = F.trim(F.regexp_replace(F.regexp_replace(c, _DOUBT, ""), _AFTER, ""))
    c = F.regexp_replace(c, r"^(.+?)\s*;\s*\1$", "$1")
    c = F.regexp_replace(c, r"^\((.*)\)$", "$1")
    return F.trim(c)


def _words(col: Column) -> Column:
    """The words without brackets that restate (dates, Chinese), separators as spaces."""
    c = F.regexp_replace(col, r"\s*[(（]\s*(?:[\d\s–-]+|[^()（）]*[぀-鿿][^()（）]*)[)）]", "")
    c = F.regexp_replace(c, r"(?<=[㐀-鿿])[代朝]$", "")
    c = F.regexp_replace(F.regexp_replace(c, r"&", " and "), r"[-/,;:()（）.’'\"]+", " ")
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def _tokens(words: Column) -> Column:
    """Letters and padded pairs of all words, numbered by occurrence."""
    parts = F.split(words, " ")
    pairs = F.flatten(F.transform(parts, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) + 1), lambda i: F.substring(F.concat(F.lit("^"), w, F.lit("$")), i, F.lit(2)))))
    letters = F.filter(F.split(F.regexp_replace(words, " ", ""), ""), lambda x: x != "")
    every = F.array_sort(F.concat(pairs, letters))
    return F.transform(every, lambda x, i: F.concat(x, F.lit("\t"), i - F.array_position(every, x)))


def osa(a: str, b: str, most: int) -> int:
    """Edit distance with swaps of neighbours (optimal string alignment), banded: only cells at most ``most`` off the
    diagonal are filled; most + 1 if the distance is larger than most."""
    n, m = len(a), len(b)
    if abs(n - m) > most:
        return most + 1
    if a == b:
        return 0
    far = most + 1
    before: list[int] = []
    last = [j if j <= most else far for j in range(m + 1)]
    for i in range(1, n + 1):
        x = a[i - 1]
        low, high = max(1, i - most), min(m, i + most)
        row = [far] * (m + 1)
        if i <= most:
            row[0] = i
        least = row[low - 1]
        for j in range(low, high + 1):
            y = b[j - 1]
            if x == y:
                d = last[j - 1]
            else:
                d = 1 + min(last[j - 1], last[j], row[j - 1])
                if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y and before[j - 2] < d:
                    d = before[j - 2] + 1
            row[j] = d
            if d < least:
                least = d
        if least > most:
            return far
        before, last = last, row
    return min(last[m], far)


@lru_cache(maxsize=20_000)
def _core(words: tuple[str, ...]) -> tuple[str, ...]:
    """Words without the one that most resembles "dynasty", "period" and the like, if others remain."""
    if len(words) < 2:
        return words
    ranked = sorted((min(osa(w, e, 9) / len(e) for e in _ERA), -i) for i, w in enumerate(words) if len(w) > 1)
    if ranked and ranked[0][0] <= 0.45:
        at = -ranked[0][1]
        return words[:at] + words[at + 1 :]
    return words


def fit(value: str, term: str, era: bool = False) -> float | None:
    """Edit distance of a value to a name of a term, words in either order; None where it is too far to be a typo."""
    most = max(1, min(4, int(0.34 * len(term) + 0.5)))
    d = osa(value, term, most)
    if d and (" " in value or " " in term):
        d = min(d, osa(" ".join(sorted(value.split())), " ".join(sorted(term.split())), most))
    if d > most:
        return None
    if era:
        a, b = _core(tuple(value.split())), _core(tuple(term.split()))
        a, b = " ".join(a), " ".join(b)
        if osa(a, b, 3) > max(1, int(0.5 * len(b))):
            return None
    return d


def names(vocab: DataFrame) -> DataFrame:
    """All accepted names of every entry (vocab, term_id, name, name_words): label, Chinese label, other names, and for
    eras the bare name with the usual era words."""
    bare = F.regexp_replace("label", r"（.*$", "")
    eras = F.when(F.col("vocab") == "dynasty", F.array(bare, *[F.concat(bare, F.lit(f" {w}")) for w in ("dynasty", "period", "era")])).otherwise(F.array(F.concat("label", F.lit(" object")), F.concat("label", F.lit("s"))))
    every = F.concat(F.array("label", "label_zh"), F.split(F.coalesce("alt_labels", F.lit("")), r"\|"), eras)
    rows = vocab.select("vocab", "term_id", F.explode(every).alias("name"))
    rows = rows.select("vocab", "term_id", F.lower(F.trim("name")).alias("name"))
    return rows.where(F.col("name") != "").withColumn("words", _words(F.col("name"))).where(F.col("words") != "").distinct()


def set_join(left: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    """Pairs (id, rid, part, jaccard) of left(id, part, tokens) and right(rid, part, tokens) whose token sets have a Jaccard
    similarity of at least threshold, found exactly: rarity order, prefixes, length and positional filter, verification.
    Null or empty token arrays give no pairs; equal sets give pairs of similarity 1.

    Rarity is that among the lists' entries (right); what no entry has comes first, fills up a value's prefix and joins
    nothing. So values are never exploded beyond the few tokens that can join, and ordering them needs no shuffle: the
    ranks go to every task if a count proves them to be few, else they are joined.
    """
    rank = cut(right.select("part", F.explode("tokens").alias("t")).groupBy("part", "t").agg(F.count("*").alias("n")))
    ranks = {(r.part, r.t): r.n for r in rank.collect()} if rank.count() <= RANK_ROWS else None

    def keep(size: int) -> int:
        return size - math.ceil(size * threshold - 1e-9) + 1

    def here(df: DataFrame, key: str) -> DataFrame:
        def make() -> Callable[..., Iterable[tuple]]:
            def step(ids: list, parts: list, sets: list) -> Iterable[tuple]:
                for i, part, tokens in zip(ids, parts, sets):
                    n = len(tokens or ())
                    order = sorted((ranks.get((part, t), 0), t) for t in tokens or ())
                    for pos, (seen, t) in enumerate(order[: keep(n)] if n else (), 1):
                        if seen:
                            yield i, part, t, pos, n

            return step

        kind = df.schema[key].dataType.simpleString()
        return map_rows(df.select(key, "part", "tokens"), make, f"{key} {kind}, part string, t string, pos int, size int")

    def joined(df: DataFrame, key: str) -> DataFrame:
        long = df.select(key, "part", F.size("tokens").alias("size"), F.explode("tokens").alias("t")).join(rank, ["part", "t"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
        long = long.withColumn("pos", F.row_number().over(Window.partitionBy("part", key).orderBy("n", "t")))
        return long.where((F.col("pos") <= F.col("size") - F.ceil(F.col("size") * threshold - 1e-9) + 1) & (F.col("n") > 0)).select(key, "part", "t", "pos", "size")

    prefixes = joined if ranks is None else here
    a = prefixes(left, "id").withColumnsRenamed({"pos": "p", "size": "s"})
    b = prefixes(right, "rid").withColumnsRenamed({"pos": "q", "size": "z"})
    need = F.ceil((F.col("s") + F.col("z")) * threshold / (1 + threshold) - 1e-9)
    ok = (F.col("z") >= F.col("s") * threshold) & (F.col("s") >= F.col("z") * threshold) & (F.least(F.col("s") - F.col("p"), F.col("z") - F.col("q")) + 1 + F.least("p", "q") - 1 >= need)
    pairs = a.join(small(cut(b), RANK_ROWS), ["part", "t"]).where(ok).select("id", "rid", "part").distinct()
    there = small(right.select("rid", "part", F.col("tokens").alias("y")), RANK_ROWS)
    pairs = pairs.join(left.select("id", "part", F.col("tokens").alias("x")), ["id", "part"]).join(there, ["rid", "part"])
    common = F.size(F.array_intersect("x", "y"))
    return pairs.withColumn("jaccard", common / (F.size("x") + F.size("y") - common)).where(F.col("jaccard") >= threshold).select("id", "rid", "part", "jaccard")


def map_values(rows: DataFrame, vocab: DataFrame, key: str = "seq", fields: tuple[str, ...] = ("type", "material", "dynasty")) -> DataFrame:
    """One row (key, field_name, term_id) per value of the fields that is no exact label; term_id 0 if no entry fits.

    NULL, empty and exactly labelled values give no rows; white space alone, and any value when the list is empty, maps
    to 0; of equally close entries the one whose label is the more frequent in the data wins, then the smaller
    term_id; columns of ``rows`` that aren't named are ignored. Distinct values are mapped once, so a hot value costs
    no more than a rare one.
    """
    values = F.explode(F.array(*[F.struct(F.lit(f).alias("part"), F.col(f).cast("string").alias("value")) for f in fields]))
    long = rows.select(F.col(key).alias("key"), values.alias("v")).select("key", "v.part", "v.value").where("value IS NOT NULL AND value <> ''")
    labels = small(vocab.select(F.col("vocab").alias("part"), F.col("label").alias("value"), F.col("term_id").alias("of")).where("value IS NOT NULL").dropDuplicates(["part", "value"]), 10_000)
    counted = cut(long.groupBy("part", "value").agg(F.count("*").alias("n")).join(labels, ["part", "value"], "left").withColumn("id", F.xxhash64("part", "value")))
    prior = counted.where("of IS NOT NULL").select(F.col("of").alias("term_id"), F.col("n").alias("prior"))
    free = counted.where("of IS NULL").withColumn("name", plain(F.col("value"))).withColumn("words", _words(F.col("name")))
    left = free.where("words <> ''").select("id", "part", "name", "words").withColumn("tokens", _tokens(F.col("words")))
    terms = names(vocab).withColumnRenamed("vocab", "part")
    right = terms.withColumn("rid", F.xxhash64("part", "term_id", "words")).dropDuplicates(["rid"]).withColumn("tokens", _tokens(F.col("words")))
    left, right = cut(left), cut(right)
    pairs = set_join(left, right, JACCARD)
    pairs = pairs.join(left.select("id", "words"), "id").join(right.select("rid", "term_id", F.col("words").alias("term")), "rid").join(prior, "term_id", "left")

    def make() -> Callable[..., Iterable[tuple]]:
        def step(ids: list, parts: list, values: list, terms: list, term_ids: list, scores: list, priors: list) -> Iterable[tuple]:
            for i, part, value, term, t, s, p in zip(ids, parts, values, terms, term_ids, scores, priors):
                d = fit(value, term, part == "dynasty")
                if d is not None:
                    yield i, t, float(d), s, p or 0

        return step

    near = map_rows(pairs.select("id", "part", "words", "term", "term_id", "jaccard", "prior"), make, "id long, term_id int, d double, jaccard double, prior long")
    # the most similar entry is kept; of entries about as similar the exact distance decides, and of equal distances the
    # more frequent entry wins
    close = near.withColumn("most", F.max("jaccard").over(Window.partitionBy("id"))).where(F.col("jaccard") >= F.col("most") - CLOSE)
    best = close.groupBy("id").agg(F.max_by("term_id", F.struct(-F.col("d"), F.col("prior"), F.col("jaccard"), -F.col("term_id"))).alias("term_id"))
    mapped = free.select("part", "value", "id").join(best, "id", "left").select("part", "value", F.coalesce("term_id", F.lit(0)).alias("term_id"))
    out = join_counted(long.join(labels, ["part", "value"], "left_anti"), cut(mapped), ["part", "value"], "inner", VALUE_ROWS)
    return out.select(F.col("key").alias(key), F.col("part").alias("field_name"), "term_id")
