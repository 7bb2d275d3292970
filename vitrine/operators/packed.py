"""Several values packed in one field: infer the delimiter of each source, split, explode with position.

Two passes. The first looks at every value of every field, tries each candidate notation and counts, per source and
field, how often the notation occurs and how often all its pieces are of the field's kind and the piece count agrees
with the other evidence in the value. The second scores the candidates of each value by *source prior x regularity of
its own pieces*, splits by the best one and explodes. The prior table has at most
``sources x fields x notations`` rows; it is joined, not collected, and is broadcast only under ``PRIOR_ROWS``.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.runtime import cut, map_rows, small

#: Largest prior table that is broadcast; a larger one is joined by shuffle.
PRIOR_ROWS = 50_000
#: Kind of value by field of an artifact.
KINDS = {"image_urls": "url", "image_paths": "path", "artist": "name", "culture": "label"}
#: Candidate delimiters, strong ones (never part of a value) first.
STRONG = {";": r"[;；]", "|": r"\|+", "、": "、", "line": r"[\r\n]+", "/": r"\s/\s"}
WEAK = {",": r"[,，]", "&": r"\s+&\s+", "and": r"\s+and\s+", "space": r"\s+"}
#: What may follow a delimiter, by kind.
START = {"url": r"(?=https?://)", "path": r"(?=/?[\w.-]+/)", "name": "", "label": ""}
USED = {"url": ";|line,space", "path": ";|line,space", "name": "", "label": ""}

_QUOTED = r'"(?:[^"\\]|""|\\.)*"'
_LIST = re.compile(rf"\s*\[?\s*{_QUOTED}(?:\s*[,;|、\n]\s*{_QUOTED})*\s*[,;|]?\s*\]?\s*")
_ONE = re.compile(_QUOTED)
_BRACKET = re.compile(r"\([^()]*\)|（[^（）]*）|\[[^\[\]]*\]")
_CJK = re.compile(r"[぀-ヿ㐀-鿿가-힯]")
#: What ends a firm's name, and what names a workshop by its place.
_SUFFIX = re.compile(r"(?:co|comp|company|sons|bros|inc|ltd)\b\.?", re.I)
_PLACED = re.compile(r"(?:house|hall|workshop|studio)\b", re.I)
_TRIM = " \t\r\n 　​﻿"
_SHAPE = {
    "url": re.compile(r"https?://(?:(?!https?://)\S)*[^\s;,|]"),
    "path": re.compile(r'(?:/|[\w.-]+/)[^|"\n\r]*\.\w{2,5}'),
}
_ANY_STRONG = re.compile(r"[;；|、\r\n]|\s/\s")


def _unquote(text: str) -> str:
    text = text[1:-1]
    return re.sub(r'\\(.)', r"\1", text.replace('""', '"')) if "\\" in text or '""' in text else text


def _quoted(text: str) -> list[str] | None:
    """The values of a list whose every value is quoted ("a","b" or ["a", "b"]), else None."""
    if '"' not in text[:3] or not _LIST.fullmatch(text):
        return None
    if text.lstrip(_TRIM).startswith("["):
        try:
            return [str(x) for x in json.loads(text) if x is not None]
        except ValueError:
            pass
    return [_unquote(x) for x in _ONE.findall(text)]


def _one_word(piece: str) -> bool:
    """A bare surname or company suffix: one Latin word, which is no full name by itself."""
    return " " not in piece and not _CJK.search(piece)


def _join_names(pieces: list[str], glue: str) -> list[str]:
    """Puts back together "Family, Given", "A & B Company", "A, B & Co." and "Messrs. A & B"."""
    out: list[str] = []
    for piece in pieces:
        last = out[-1] if out else ""
        family = re.sub(r"^(?:messrs\.?|attributed to|attr\.|the)\s+", "", last, flags=re.I)
        back = _SUFFIX.fullmatch(piece) or glue == ", " and _one_word(piece) and _PLACED.match(family)
        if out and (back or _one_word(family) or glue != ", " and re.fullmatch(r"\S+, \S+", family)):
            out[-1] = last + glue + piece
        else:
            out.append(piece)
    return out


def _cutters(kind: str) -> list[tuple[str, re.Pattern]]:
    return [(n, re.compile(rf"(?:\s*{d}\s*)+{START[kind]}" if n != "space" else rf"\s+{START[kind]}")) for n, d in (STRONG | WEAK).items() if (n in USED[kind] if USED[kind] else n != "space")]


def _regular(piece: str, kind: str, used: str) -> bool:
    """Is the piece of the field's kind, with no delimiter left over?"""
    if kind in _SHAPE:
        return bool(_SHAPE[kind].fullmatch(piece))
    bare = _BRACKET.sub("", piece)
    if _ANY_STRONG.search(bare):
        return False
    if kind == "label":
        return not re.search(r"[,，]|\s(?:&|and)\s", bare)
    head, comma, _ = bare.partition(",")
    if comma and not _one_word(re.sub(r"^(?:attributed to|attr\.)\s+", "", head, flags=re.I)):
        return False
    if used not in ("&", "and") and len(_join_names(re.split(r"\s+(?:&|and)\s+", bare), " & ")) > 1:
        return False
    return bool(_CJK.search(piece)) or " " in piece


def readings(text: str, kind: str, cutters: list[tuple[str, re.Pattern]]) -> list[tuple[str, list[str], float]]:
    """(notation, pieces, share of regular pieces) for every candidate notation that parts the value."""
    quoted = _quoted(text)
    if quoted is not None:
        pieces = [p for x in quoted if (p := x.strip(_TRIM))]
        return [("quoted", pieces, 1.0)] if len(pieces) > 1 else []
    text = text.strip(_TRIM)
    spans = [m.span() for m in _BRACKET.finditer(text)] if kind in ("name", "label") else []
    found: list[tuple[str, list[tuple[int, int]]]] = []
    for name, cutter in cutters:
        hits = [m.span() for m in cutter.finditer(text) if not any(a <= m.start() < b for a, b in spans)]
        if hits:
            found.append((name, hits))
    strong = [f for f in found if f[0] in STRONG]
    if len(strong) > 1:
        found.append(("+".join(n for n, _ in strong), sorted(h for _, hits in strong for h in hits)))
    out = []
    for name, hits in found:
        pieces, at = [], 0
        for a, b in [*hits, (len(text), len(text))]:
            piece = text[at:a].strip(_TRIM)
            if len(piece) > 1 and piece[0] == piece[-1] == '"':
                piece = _unquote(piece).strip(_TRIM)
            if piece:
                pieces.append(piece)
            at = max(at, b)
        if kind in _SHAPE and pieces:
            pieces[-1] = pieces[-1].rstrip(";,|" + _TRIM)
        if kind == "name" and name in (",", "&", "and"):
            pieces = _join_names(pieces, {",": ", ", "&": " & ", "and": " and "}[name])
        if len(pieces) > 1:
            out.append((name, pieces, sum(_regular(p, kind, name) for p in pieces) / len(pieces)))
    return out


def values_of(text: str | None, kind: str = "name") -> list[str]:
    """The values of one text by its own evidence alone; one value for an undivided text, none for a blank one."""
    if not text or not text.strip(_TRIM):
        return []
    read = readings(text, kind, _CUTTERS.setdefault(kind, _cutters(kind)))
    if not read:
        one = _quoted(text)
        return one or [text.strip(_TRIM)]
    return max(read, key=lambda r: r[2])[1]


_CUTTERS: dict[str, list[tuple[str, re.Pattern]]] = {}


def _long(df: DataFrame, key: str, source: str, kinds: dict[str, str]) -> DataFrame:
    """One row per non-empty field that holds any candidate delimiter: (key, source, field_name, value)."""
    fields = F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).cast("string").alias("value")) for f in kinds]))
    return df.select(F.col(key).alias("key"), F.col(source).cast("string").alias("source"), fields.alias("f")).select("key", "source", "f.field_name", "f.value").where(F.col("value").rlike(r'[;；|、\r\n,，"]|\s(?:/|&|and|https?://\S+|[\w.-]+/\S)\s?'))


def infer_delimiters(df: DataFrame, source: str = "museum_id", kinds: dict[str, str] | None = None) -> DataFrame:
    """Per source, field and notation: values that may be read so, how many of them regularly, and the score.

    score = smoothed share of regular readings x agreement x consistency of the piece counts. Agreement is the share of the
    readings whose piece count no other candidate reading of equal regularity contradicts; consistency compares the
    piece counts of all values of the source with each other: 1 / (1 + their variance over their squared mean), which is
    1 where every value has as many pieces. Empty input gives an empty table.
    """
    kinds = kinds or KINDS

    def make() -> Callable[..., Iterable[tuple]]:
        cutters = {f: _cutters(k) for f, k in kinds.items()}

        def step(sources: list, fields: list, values: list) -> Iterable[tuple]:
            seen: Counter = Counter()
            for source, field, value in zip(sources, fields, values):
                read = readings(value, kinds[field], cutters[field])
                best = max((r for *_, r in read), default=0)
                for name, pieces, regular in read:
                    agree = all(len(p) == len(pieces) for _, p, r in read if r == best) if regular == best else False
                    seen[source, field, name, regular == 1, agree, len(pieces)] += 1
            for (source, field, name, regular, agree, k), n in seen.items():
                yield source, field, name, n, n if regular else 0, n if agree else 0, n * k, n * k * k

        return step

    parts = map_rows(_long(df.withColumn("__k", F.lit(0)), "__k", source, kinds).select("source", "field_name", "value"), make, "source string, field_name string, notation string, n long, regular long, agreed long, pieces long, squares long")
    sums = parts.groupBy("source", "field_name", "notation").agg(*[F.sum(c).alias(c) for c in ("n", "regular", "agreed", "pieces", "squares")])
    # the mean of the squares over the squared mean is 1 + variance over squared mean
    consistency = F.col("pieces") * F.col("pieces") / (F.col("n") * F.col("squares"))
    score = (F.col("regular") + 1) / (F.col("n") + 2) * (F.col("agreed") + 1) / (F.col("n") + 2) * consistency
    return sums.withColumn("consistency", consistency).withColumn("score", score).drop("pieces", "squares")


def split_packed(df: DataFrame, key: str = "seq", source: str = "museum_id", kinds: dict[str, str] | None = None) -> DataFrame:
    """One row (key, field_name, pos, item) per value of every field that holds at least two values.

    NULL, empty and one-valued fields give no rows; empty pieces are skipped and not counted; repeated values are kept
    at their positions; a NULL source is a source of its own; other columns of ``df`` are ignored. Texts of any length
    are split whole.
    """
    kinds = kinds or KINDS
    values = _long(df, key, source, kinds)
    priors = infer_delimiters(df, source, kinds).groupBy("source", "field_name").agg(F.map_from_entries(F.collect_list(F.struct("notation", "score"))).alias("prior"))
    priors = small(cut(priors), PRIOR_ROWS)
    kind_of = kinds

    def make() -> Callable[..., Iterable[tuple]]:
        cutters = {f: _cutters(k) for f, k in kind_of.items()}

        def step(keys: list, fields: list, texts: list, scores: list) -> Iterable[tuple]:
            for k, field, text, prior in zip(keys, fields, texts, scores):
                read = readings(text, kind_of[field], cutters[field])
                if not read:
                    continue
                prior = dict(prior or ())
                _, pieces, regular = max(read, key=lambda r: (r[2] == 1, r[2] * prior.get(r[0], 0.25)))
                if regular > 0 and len(pieces) > 1:
                    for pos, piece in enumerate(pieces, 1):
                        yield k, field, pos, piece

        return step

    joined = values.join(priors, (F.coalesce(values.source, F.lit("\0")) == F.coalesce(priors.source, F.lit("\0"))) & (values.field_name == priors.field_name), "left").select("key", values.field_name, "value", "prior")
    kind = df.schema[key].dataType.simpleString()
    return map_rows(joined, make, f"key {kind}, field_name string, pos int, item string").withColumnRenamed("key", key)
