"""Sentence boundaries across languages and scripts: a semi-Markov dynamic programme over whole spans.

A text is cut at places where no sentence goes on (blank lines, list lines, headings). In between, every place that may
end a sentence (after an end mark with its closing quotes and brackets, at a line end, at a space between Chinese or
Thai words) is a candidate, and none is ruled out beforehand. The programme picks the spans between candidates whose
summed score is best. A span is scored as a whole: how its last word and mark close it, how its first word opens it, how
usual its length is in its script, and how many quotations and brackets its ends would cut. Each part can outvote the
others: an initial before "The" ends a sentence if both sides are long enough, a quotation of several sentences stays
whole although each of them is well closed, and a two-letter sentence needs a clear end.

The time is linear in the length of a text. Marks, neighbours and open quotations are read in one pass each. Going back
from an end, the programme stops where no earlier begin can win, and a begin that an earlier one beats for every later
end, by more than any length can make up for, is never looked at again; both bounds are exact.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.runtime import map_rows

#: Abbreviations that hardly ever end a sentence.
OPEN_ABBREVIATIONS = set(
    "mr mrs ms dr prof rev hon gen col capt lt sgt st mt no nos fig figs vol vols pp p pl pls cf eg ie viz approx ca c b d fl inv acc cat ed eds tr dept est bros "
    "jan feb mar apr jun jul aug sep sept oct nov dec "
    "z u nr abb s vgl bd hrsg bzw sog geb gest inv.-nr str m mm mme mlle mgr env av apr ex p.ex chap sr sra srta dra da núm pág págs aprox art cap "
    "см рис стр т табл напр им ул г-н г-жа проф тыс млн млрд руб डॉ पृ सं श्री प्रो".split()
)
#: Abbreviations that may stand last, so that what follows decides.
LAST_ABBREVIATIONS = set(
    "co ltd inc corp jr al etc a.m p.m am pm ph.d m.a b.a u.s u.s.a u.k usa e.v usw u.a z.b d.h a h cía sa гг г вв в др пр кг см мм и.т.д т.д т.п esq".split()
)
#: Words that open sentences more often than they follow an initial or an abbreviation.
OPENERS = frozenset(
    "The A It Its In On At She They This That These Those There We Who What Why How When Where If For From After Before Under But And No One My Our His Her Each Both Some Many "
    "Der Die Das Ein Eine Es Er Sie Wir Im Am Auf Aus Bei Nach Vor Wer Was Wie Wo Laut Le La Les Un Une Il Elle Ce Cette Ces Nous En Au Dans Pour Que Qui "
    "El Los Las Una Se Su Por В На Он Она Они Это По При Из Как Кто Что Где".split()
)
#: Nouns and months that follow a German ordinal.
ORDINAL = re.compile(
    r"(?:Januar|Februar|März|April|Mai|Juni|Juli|August|September|Oktober|November|Dezember|Jahrhundert|Jh\b|Auflage|Band|Kapitel)"
)
#: Verbs of saying that carry a sentence on after a quotation, where letters have no case.
SAYING = re.compile(r"(?:と|[^。！？।\n，,；;：:]{0,30}(?:道|说|說|问|問|曰|云|पूछा|कहा|बोला|बोली|लिखा)\s*[，,。।])")

_CJK = r"㐀-鿿぀-ヿ豈-﫿ｦ-ﾟ"
_THAI = r"฀-๿"
_CLOSE = r"[\"'”“’»」』）)\]】〉》]"
_CLOSE_WIDE = _CLOSE.replace("“", "")
_CLOSERS = frozenset("\"'”“’»」』）)]】〉》")
_OPEN = "\"'“‘„«「『（([【〈《¿¡"
_MARK = re.compile(
    rf"[.!?…‽\n।॥؟۔。！？｡．](?:(?<=[.!?…‽])[.!?…‽]*(?:\s*»)?{_CLOSE}*(?=\s|$)|(?<=[।॥؟۔])[।॥؟۔]*{_CLOSE}*(?=\s|$)"
    rf"|(?<=[。！？｡．])[。！？｡．]*{_CLOSE_WIDE}*|(?<=\n)[ \t　]*)"
)
_WIDE = frozenset("।॥؟۔。！？｡．")
_GAP = re.compile(rf"(?<=[{_CJK}{_THAI}])[   　]+(?=[{_CJK}{_THAI}“「『《])|(?<=[{_CJK}])[   　]+(?=\d)")
_WRITTEN = re.compile(f"[{_CJK}{_THAI}]")
_THAI_LETTER = re.compile(f"[{_THAI}]")
_BLANK = re.compile(r"\n[ \t　\r]*(?:\n[ \t　\r]*)+")
_PLAIN_BULLET = re.compile(r"[ \t　]*(?:[-•◦▪‣*·●○][ \t　]+\S|[–—][ \t　]+[^\Wa-zà-ÿа-я])")
_NUMBERED = re.compile(r"[ \t　]*\(?(?:(\d{1,3})[.)](?!\d)|([a-zA-Z])\))[ \t　]+\S")
_CASELESS = re.compile(rf"[{_CJK}ऀ-ॿ؀-ۿ{_THAI}]")
_TOKEN = re.compile(r"[^\s,;:!?()\[\]\"“”«»„]{1,40}")
_NAMED = re.compile(r"[A-ZÀ-ÞЀ-Я]")
_PAIRS = {"(": ")", "[": "]", "（": "）", "«": "»", "「": "」", "『": "』", "《": "》", "【": "】"}
_SIGN = re.compile(r'["“”„()\[\]（）«»「」『』《》【】]')


@dataclass(frozen=True)
class Weights:
    """What the parts of a span's score weigh; 0 leaves a part out."""

    length: float = 0.35
    opening: float = 1.0
    closing: float = 1.0
    balance: float = 7.0


WEIGHTS = Weights()
#: Mean of the logarithm of a sentence's length in characters: letters, Chinese and Japanese, Thai.
MEAN = {"letters": 4.2, "wide": 3.0, "thai": 3.5}
_LONGEST_TABLE = 4096


def _costs(mean: float, weight: float) -> list[float]:
    return [weight * (math.log(max(n, 1)) - mean) ** 2 for n in range(_LONGEST_TABLE)]


def _gains(mean: float, weight: float) -> list[float]:
    """Entry k: the most that a span of any length may cost less for beginning up to 2 ** (k / 8) characters later."""
    lengths = sorted({round(1.05**i) for i in range(600)})
    cost = {n: weight * (math.log(n) - mean) ** 2 for n in lengths}
    later = [2 ** (k / 8) for k in range(320)]
    return [max(max(0.0, weight * (math.log(n + d) - mean) ** 2 - cost[n]) for n in lengths) + 0.01 for d in later]


def _dot(word: str, rest: str) -> float:
    """How a full stop after this word closes a sentence."""
    low = word.lower().strip("'’-")
    if word.isalpha() and len(word) == 1 and _NAMED.match(word):
        return -2.5  # an initial, or the last letter of a sentence
    last = low.rpartition(".")[2]
    if low in LAST_ABBREVIATIONS or last in LAST_ABBREVIATIONS and "." in low:
        follows = _TOKEN.match(rest)
        if follows and follows[0].endswith(".") and follows[0][:-1].lower() in LAST_ABBREVIATIONS:
            return -6.0
        return -4.0 if rest[:1].isdigit() and len(low) < 3 else 1.3
    if low in OPEN_ABBREVIATIONS or len(low) == 1 and low.isalpha() or last in OPEN_ABBREVIATIONS and "." in low:
        return -7.5
    if low.isdigit() and len(low) <= 2 and ORDINAL.match(rest):
        return -9.0
    if word.istitle():  # a firm's name before "Co." and the like
        follows = _TOKEN.match(rest)
        if follows and follows[0].endswith(".") and len(follows[0]) > 2 and follows[0][:-1].lower() in LAST_ABBREVIATIONS:
            return -3.5
    return 3.0


def _opening(rest: str) -> float:
    """How the text after an end opens a sentence."""
    first = rest[0]
    if first in _OPEN:
        inner = rest.lstrip(_OPEN + "   ")[:1]
        return -9.0 if inner.islower() and first not in "¿¡" and not rest[1:3].strip().isupper() else 1.3
    if first.islower():
        return 1.0 if rest[1:2].isupper() else -9.0  # "pH" opens, a word in small letters doesn't
    if first.isupper():
        token = _TOKEN.match(rest)
        return 3.0 if token and token[0] in OPENERS else 1.0
    if first.isdigit():
        return 0.8
    if first in "-–—":
        inner = rest.lstrip("-–—  ")[:1]
        return 0.5 if inner.isupper() or _CASELESS.match(inner or "a") else -9.0
    return 1.0 if _CASELESS.match(first) else 0.0


def _signs(text: str, start: int, stop: int) -> list[tuple[int, int]]:
    """(from, to) of every quotation and bracket that is opened and closed in the block; what has no partner is left out."""
    stack: list[tuple[str, int]] = []
    pairs: list[tuple[int, int]] = []
    for m in _SIGN.finditer(text, start, stop):
        sign, at = m[0], m.start()
        if sign == '"':
            before, after = text[at - 1 : at] if at > start else " ", text[at + 1 : at + 2] if at + 1 < stop else " "
            opens = (before.isspace() or before in "([-–—:") and not after.isspace()
            wanted = '"'
        elif sign == "“":  # opens in English and Chinese, closes in German
            opens = not any(s == "„" for s, _ in stack)
            wanted = "„"
        elif sign in _PAIRS or sign == "„":
            opens, wanted = True, ""
        else:
            opens, wanted = False, {"”": "“"}.get(sign) or next(a for a, b in _PAIRS.items() if b == sign)
        if opens:
            if sign == '"':  # the earlier one of two openings has no partner
                stack = [x for x in stack if x[0] != '"']
            stack.append((sign, at))
            continue
        for k in range(len(stack) - 1, max(-1, len(stack) - 9), -1):  # nothing nests deeper than a few levels
            if stack[k][0] == wanted:
                pairs.append((stack[k][1], at))
                del stack[k:]
                break
        if len(stack) > 64:  # openings that were never closed
            del stack[:32]
    return pairs


def _block(text: str, start: int, stop: int, weights: Weights = WEIGHTS) -> list[tuple[int, int]]:
    """Spans of one block that has no blank line and no list line in it."""
    wide = any(text.find(mark, start, stop) >= 0 for mark in "。！？")
    ends: list[int] = []
    begins: list[int] = [start]
    scores: list[float] = []
    gaps = iter(_GAP.finditer(text, start, stop)) if _WRITTEN.search(text, start, stop) else iter(())
    gap = next(gaps, None)

    def put(end: int, following: int, score: float) -> None:
        if ends and following <= begins[-1]:
            return
        ends.append(end)
        begins.append(following)
        scores.append(score)

    def spaces(upto: int) -> None:
        nonlocal gap
        while gap is not None and gap.start() < upto:
            a, b = gap.span()
            thai = _THAI_LETTER.match(text, a - 1) is not None
            put(a, b, 3.0 if thai or not wide else -3.0)
            gap = next(gaps, None)

    for m in _MARK.finditer(text, start, stop):
        s, e = m.span()
        if gap is not None:
            spaces(s)
        first = text[s]
        following = e
        while following < stop and text[following].isspace():
            following += 1
        if following >= stop:
            break
        if first == "\n":
            end = s
            while end > begins[-1] and text[end - 1].isspace():
                end -= 1
            if end <= begins[-1]:
                continue
            before, after = text[end - 1], text[following]
            if _WRITTEN.match(before) and (_WRITTEN.match(after) or after in _OPEN or after.isdigit() and not _THAI_LETTER.match(before)):
                put(end, following, 3.0 if not wide or _THAI_LETTER.match(before) else -3.0)
            elif before in ",，、；;：:":
                put(end, following, -5.0)
            else:
                put(end, following, -4.0)
            continue
        rest = text[following : following + 48]
        quoted = e - s > 1 and text[e - 1] in "\"'”“’»」』"
        if first in _WIDE:
            if quoted and SAYING.match(rest):
                score = -8.0
            else:
                score = weights.closing * 3.0 + weights.opening * 1.0
        elif first == "." and e == s + 1 or first == "." and text[s + 1] in _CLOSERS and not quoted:
            at = max(begins[-1], s - 40)
            left = text[at:s].rsplit(None, 1)
            word = left[-1].lstrip("\"“«„([（") if left else ""
            score = weights.closing * (3.0 if e > s + 1 else _dot(word, rest)) + weights.opening * _opening(rest)
        elif "." in m[0] and not quoted or first == "…":
            score = weights.closing * 1.0 + weights.opening * _opening(rest)
        else:
            inner = rest.lstrip(_OPEN + "-–—  ")[:1]
            if quoted and _CASELESS.match(inner or "a") and (SAYING.match(rest) or rest[0] not in "\"“«" and "ऀ" <= inner <= "ॿ"):
                score = -8.0
            else:
                score = weights.closing * (1.0 if first == "." and m[0].startswith("..") else 3.2) + weights.opening * _opening(rest)
        put(e, following, score)
    if gap is not None:
        spaces(stop)
    if ends and begins[-1] >= stop:
        ends.pop(), scores.pop(), begins.pop()
    n = len(ends)
    if not n:
        return [(start, stop)]
    if weights.balance and (pairs := _signs(text, start, stop)):
        # an end between the signs of a pair cuts it; differences summed over the ends count the pairs cut
        change = [0] * (n + 1)
        pairs.sort()
        low = 0
        order = sorted(b for _, b in pairs)
        k = 0
        for j in range(n):
            while low < len(pairs) and pairs[low][0] < ends[j]:
                low += 1
            while k < len(order) and order[k] < ends[j]:
                k += 1
            change[j] = low - k
        scores = [x - weights.balance * c for x, c in zip(scores, change)]
    ends.append(stop)
    scores.append(0.0)
    sample = _WRITTEN.findall(text, start, min(stop, start + 200))
    if len(sample) * 3 < min(200, stop - start):
        script = "letters"
    else:
        script = "thai" if _THAI_LETTER.match(sample[len(sample) // 2]) else "wide"
    return _best(begins, ends, scores, script, weights.length)


_TABLES: dict[tuple[str, float], tuple[list[float], list[float]]] = {}


def _best(begins: list[int], ends: list[int], scores: list[float], script: str, weight: float) -> list[tuple[int, int]]:
    """The spans whose scores, less the cost of their lengths, sum up best."""
    key = script, weight
    if key not in _TABLES:
        _TABLES[key] = _costs(MEAN[script], weight), _gains(MEAN[script], weight)
    (table, gains), mean = _TABLES[key], MEAN[script]
    back = [0] * len(ends)
    live: list[int] = [0]  # begins that may still win
    worth: list[float] = [0.0]  # the best score before each of them
    most: list[float] = [0.0]  # the best of worth up to there
    last = len(ends) - 1
    for j, end in enumerate(ends):
        best, at, of = -1e300, 0, 0
        for k in range(len(live) - 1, -1, -1):
            if most[k] <= best:
                break
            i = live[k]
            size = end - begins[i]
            v = worth[k] - (table[size] if size < _LONGEST_TABLE else weight * (math.log(size) - mean) ** 2)
            if v > best:
                best, at, of = v, i, k
        back[j] = at
        best += scores[j]
        if j < last:
            begin = begins[j + 1]
            # an earlier begin that is better by more than the length can ever make up for leaves this one no chance
            if best < worth[of] and best + gains[int(8 * math.log2(begin - begins[at])) + 1] <= worth[of]:
                continue
            live.append(j + 1)
            worth.append(best)
            most.append(max(best, most[-1]))
    spans, j = [], last
    while j >= 0:
        spans.append((begins[back[j]], ends[j]))
        j = back[j] - 1
    return spans[::-1]


def _numbered(lines: list[str]) -> list[bool]:
    """Which lines are items of a numbered or lettered list: two neighbours at least that count on."""
    values = [(m[1] and int(m[1]) or m[2] and ord(m[2])) if (m := _NUMBERED.match(x)) else None for x in lines]
    out = [False] * len(lines)
    for k, (a, b) in enumerate(zip(values, values[1:])):
        if a is not None and b is not None and b == a + 1:
            out[k] = out[k + 1] = True
    return out


def sentences(text: str | None, weights: Weights = WEIGHTS) -> list[tuple[int, int]]:
    """(start, end) of the sentences of a text, in order, without white space around them."""
    if not text or not text.strip():
        return []
    out: list[tuple[int, int]] = []
    at = 0
    blocks = []
    for m in _BLANK.finditer(text):
        blocks.append((at, m.start()))
        at = m.end()
    blocks.append((at, len(text)))
    for start, stop in blocks:
        if "\n" not in text[start:stop]:
            if start < stop:
                out.append((start, stop)) if _PLAIN_BULLET.match(text, start, stop) else out.extend(_block(text, start, stop, weights))
            continue
        lines, begin = [], start
        while begin < stop:
            end = text.find("\n", begin, stop)
            end = stop if end < 0 else end
            lines.append((begin, end))
            begin = end + 1
        items = _numbered([text[a:b][:40] for a, b in lines])
        items = [n or _PLAIN_BULLET.match(text, a, b) is not None for n, (a, b) in zip(items, lines)]
        since = start
        for item, (a, b) in zip(items, lines):
            if item:
                if since < a:
                    out.extend(_block(text, since, a, weights))
                out.append((a, b))
                since = min(b + 1, stop)
        if since < stop:
            out.extend(_block(text, since, stop, weights))
    trimmed = []
    for a, b in out:
        while a < b and text[a].isspace():
            a += 1
        while b > a and text[b - 1].isspace():
            b -= 1
        if a < b:
            trimmed.append((a, b))
    return trimmed


def split_sentences(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row (key, sent_no, start_at, end_at) per sentence; offsets in code points, 0-based, end exclusive.

    NULL, empty and blank texts give no rows; a text without any end mark is one sentence per block or line; repeated
    texts are split each; texts of any length are split whole, in time that grows as their length; extra columns are
    ignored.
    """

    def make() -> Callable[..., Iterable[tuple]]:
        def step(ids: list, texts: list) -> Iterable[tuple]:
            for i, t in zip(ids, texts):
                for n, (a, b) in enumerate(sentences(t), 1):
                    yield i, n, a, b

        return step

    kind = documents.schema[key].dataType.simpleString()
    return map_rows(documents.select(F.col(key), F.col(text).cast("string")), make, f"{key} {kind}, sent_no int, start_at int, end_at int")
