"""Evaluation texts leaking into training text: one Aho-Corasick automaton over the normalised test items.

Texts are normalised to lower-case letters and digits without spaces, with a map back to the original. The automaton
holds every window of the items that is long enough to be telling (10 letters; 6 characters in Chinese); each document
is scanned once. A hit fixes how an item lies over the document; from there the item's words are followed to both
sides, a word may differ in one letter if its neighbours don't, and the longest run of words decides. The items are
dealt into parts of bounded size (``PART_CHARS``); each part has its own automaton, which every task builds from one
broadcast copy, and the documents are scanned once for each part. A benchmark of usual size is one part.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.runtime import map_rows

#: Consecutive words (characters in Chinese) of an item that make a case.
WORDS, CHARACTERS = 12, 20
#: Length of the windows in the automaton.
WINDOW, WINDOW_CJK = 10, 6
#: Characters of test items in one automaton; more items make more parts.
PART_CHARS = 4_000_000

_TOKEN = re.compile(r"[^\W_]+|&")
_CJK = re.compile(r"[぀-ヿ㐀-鿿]")


class Item(NamedTuple):
    key: int
    text: str  # normalised
    starts: list[int]  # where its words begin in text
    words: list[str]
    need: int


#: Letters of other scripts that look like Latin ones, and what they look like.
LOOKS = dict(zip("аеорсухіѕјһԁӏԛԝкмтвнгαοερνικτυχ", "aeopcyxisjhdlqwkmtbhraoepviktux"))


class _Fold(dict):
    """Letter by letter: without accents, full width to half, lookalikes to Latin."""

    def __missing__(self, c: int) -> int:
        plain = unicodedata.normalize("NFKD", chr(c))[:1].lower() or chr(c)
        self[c] = out = ord(LOOKS.get(plain, plain))
        return out


_FOLD = _Fold()


class _Squash(dict):
    """Letter by letter: as _Fold, and nothing for what is no letter or digit."""

    def __missing__(self, c: int) -> str | None:
        out = chr(_FOLD[c]) if chr(c).isalnum() else None
        self[c] = out
        return out


_SQUASH = _Squash()


def squash(text: str) -> str:
    """What normalise gives, without the places."""
    return text.replace("&", "and").translate(_SQUASH)


def normalise(text: str) -> tuple[str, list[int], list[int]]:
    """Letters and digits of a text in lower case without spaces; where each word begins there, and in the original."""
    parts, at, origin, n = [], [], [], 0
    for m in _TOKEN.finditer(text):
        word = "and" if m[0] == "&" else m[0] if m[0].isascii() and m[0].islower() else m[0].translate(_FOLD)
        parts.append(word)
        at.append(n)
        origin.append(m.start())
        n += len(word)
    return "".join(parts), at, origin


def items_of(rows: Iterable[tuple[int, str | None]]) -> list[Item]:
    """Normalised items; a Chinese item is followed by characters, any other by words."""
    out = []
    for key, text in rows:
        joined, at, _ = normalise(text or "")
        if not joined:
            continue
        if len(_CJK.findall(joined)) * 2 > len(joined):
            out.append(Item(key, joined, list(range(len(joined))), list(joined), CHARACTERS))
        else:
            out.append(Item(key, joined, at, [joined[a:b] for a, b in zip(at, [*at[1:], len(joined)])], WORDS))
    return out


def automaton(items: list[Item]):  # noqa: ANN201
    """All windows of all items; a value is the list of (item, place)."""
    import ahocorasick  # noqa: PLC0415

    windows: dict[str, list[tuple[int, int]]] = {}
    for i, item in enumerate(items):
        size = WINDOW_CJK if item.need == CHARACTERS else WINDOW
        for p in range(len(item.text) - size + 1):
            windows.setdefault(item.text[p : p + size], []).append((i, p))
    a = ahocorasick.Automaton()
    for w, places in windows.items():
        a.add_word(w, (len(w), places))
    if windows:
        a.make_automaton()
    return a


def _step(doc: str, at: int, word: str) -> int | None:
    """Where the document goes on if a word with one changed letter stands at ``at``: changed, swapped, missing or extra."""
    n = len(word)
    if n < 2 or word.isdigit():
        return None
    same = doc[at : at + n]
    if len(same) == n:
        off = [i for i in range(n) if same[i] != word[i]]
        if len(off) == 1 and not (same[off[0]].isdigit() or word[off[0]].isdigit()):
            return at + n
        if len(off) == 2 and off[1] == off[0] + 1 and same[off[0]] == word[off[1]] and same[off[1]] == word[off[0]] and n > 2:
            return at + n
    if n > 3:
        k = next((i for i in range(n) if at + i >= len(doc) or doc[at + i] != word[i]), n)
        if doc[at + k : at + n - 1] == word[k + 1 :]:
            return at + n - 1
        if doc[at + k + 1 : at + n + 1] == word[k:] and len(doc) > at + n:
            return at + n + 1
    return None


def _back(doc: str, at: int, word: str) -> int | None:
    """As _step, from the end of the word backwards; the mirrored texts answer it."""
    window = doc[max(0, at - len(word) - 2) : at][::-1]
    to = _step(window, 0, word[::-1])
    return None if to is None else at - to


def _goes_on(doc: str, at: int, words: list[str], k: int) -> bool:
    """Does word k stand where a changed word beside it, one letter longer or shorter, lets it stand? A changed word whose
    neighbour doesn't follow is a rim and counts for nothing, so this spares its comparison."""
    if k >= len(words) or at < 0:
        return k < len(words)
    w = words[k]
    return doc.startswith(w, at) or doc.startswith(w, at + 1) or at > 0 and doc.startswith(w, at - 1)


def run_at(doc: str, item: Item, place: int, at: int) -> tuple[int, int, int]:
    """(words, begin, end) of the longest run of the item's words around the hit item.text[place] = doc[at]."""
    fuzzy = item.need == WORDS
    first = bisect_right(item.starts, place - 1)
    if first >= len(item.words):
        return 0, at, at
    begin = end = at + item.starts[first] - place
    n, changed = 0, -9
    for k in range(first, len(item.words)):
        w = item.words[k]
        if doc.startswith(w, end):
            end += len(w)
        elif fuzzy and k - changed > 1 and _goes_on(doc, end + len(w), item.words, k + 1) and (to := _step(doc, end, w)) is not None:
            end, changed = to, k
        else:
            break
        n += 1
    tail = 1 if n and changed == first + n - 1 else 0  # a changed word at the rim proves nothing
    changed = len(item.words) + 9
    k = first - 1
    while k >= 0:
        w = item.words[k]
        if begin >= len(w) and doc.startswith(w, begin - len(w)):
            begin -= len(w)
        elif fuzzy and changed - k > 1 and k and _goes_on(doc, begin - len(w) - len(item.words[k - 1]), item.words, k - 1) and (to := _back(doc, begin, w)) is not None:
            begin, changed = to, k
        else:
            break
        n += 1
        k -= 1
    head = 1 if changed == k + 1 else 0
    return n - tail - head, begin, end


def passages(text: str | None, items: list[Item], a) -> list[tuple[int, int, int, int]]:  # noqa: ANN001
    """(item key, words, begin, end) per item that leaked into the text, offsets in the original."""
    if not text or not len(a):
        return []
    doc = squash(text)
    best: dict[int, tuple[int, int, int]] = {}
    seen: dict[int, list[tuple[int, int, int]]] = {}
    for last, (size, places) in a.iter(doc):
        begin = last - size + 1
        for i, p in places:
            if any(lo <= begin <= hi and abs(begin - p - d) <= 3 for lo, hi, d in seen.get(i, ())):
                continue
            n, b, e = run_at(doc, items[i], p, begin)
            seen.setdefault(i, []).append((min(b, begin), max(e, begin), begin - p))
            if n > best.get(i, (0,))[0]:
                best[i] = n, b, e
    out = []
    if all(n < items[i].need for i, (n, _, _) in best.items()):
        return out
    _, at, origin = normalise(text)
    for i, (n, b, e) in best.items():
        if n >= items[i].need:
            place = lambda x: origin[(k := bisect_right(at, x) - 1)] + (x - at[k])
            out.append((items[i].key, n, place(b), place(max(b, e - 1)) + 1))
    return out


def leaks(documents: DataFrame, tests: DataFrame, doc_key: str = "doc_id", item_key: str = "item_id", text: str = "text", part_chars: int = PART_CHARS) -> DataFrame:
    """One row (item_id, doc_id, words, start_at, end_at) per item and document that holds a run of its words.

    NULL and empty texts on either side give no rows; of several passages of one item in a document the longest is
    given; repeated items each give rows; items shorter than a case can't leak; texts are scanned whole whatever their
    length; items may be as many as they like; extra columns are ignored.
    """
    size = tests.agg(F.sum(F.length(text))).first()[0] or 0
    parts = max(1, -(-size // part_chars))
    spark = documents.sparkSession
    rows = documents.select(F.col(doc_key), F.col(text).cast("string"))
    kinds = [tests.schema[item_key].dataType.simpleString(), documents.schema[doc_key].dataType.simpleString()]
    schema = f"{item_key} {kinds[0]}, {doc_key} {kinds[1]}, words int, start_at int, end_at int"
    dealt = tests.select(item_key, F.col(text).cast("string").alias("text")).withColumn("part", F.pmod(F.xxhash64(item_key, "text"), F.lit(parts)))

    def scan(part: int) -> DataFrame:
        shared = spark.sparkContext.broadcast([(r[0], r[1]) for r in dealt.where(F.col("part") == part).select(item_key, "text").collect()])

        def make() -> Callable[..., Iterable[tuple]]:
            items = items_of(shared.value)
            a = automaton(items)

            def step(ids: list, texts: list) -> Iterable[tuple]:
                for d, t in zip(ids, texts):
                    for i, n, b, e in passages(t, items, a):
                        yield i, d, n, b, e

            return step

        return map_rows(rows, make, schema)

    return reduce(DataFrame.unionByName, [scan(p) for p in range(parts)])
