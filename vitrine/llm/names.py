"""Reading a name as it was typed: persons, firms and workshops, in any order, romanisation or abbreviation.

``read`` turns a name into the forms under which its variants meet: *full* forms, which may be compared by edit
distance, and *short* forms (surname and initials), which mean somebody only together with a year.
"""

from __future__ import annotations

import re
import unicodedata
from typing import NamedTuple

_CJK = re.compile(r"[㐀-鿿]+")
_HAO = re.compile(r"^\s*(?:hao|zi|alias|called)\s+", re.I)
_ATTR = re.compile(r"^(?:attributed\s+to|attr\.?(?:\s+to)?|ascribed\s+to)\s+", re.I)
_FIRM = re.compile(r"\b(?:co|comp|company|compy|& sons|bros)\b\.?\s*$", re.I)
_PSEUDONYM = re.compile(r"\b(?:shanren|jushi|daoren|zhuren|sanren|laoren)$", re.I)
#: Words of workshops, with what their other forms come down to.
TRADE = {"workshop": "workshop", "workshops": "workshop", "guild": "guild", "makers": "maker", "maker": "maker", "studio": "studio", "hall": "hall", "house": "house", "foundry": "foundry", "press": "press", "kiln": "kiln", "weaving": "weav", "weavers": "weav", "print": "print", "prints": "print", "fan": "fan", "fans": "fan", "jade": "jade", "lacquer": "lacquer", "bronze": "bronze", "album": "album", "albums": "album"}
_TRADE_END = {"workshop", "guild", "maker", "studio", "hall", "house", "foundry", "press", "kiln"}
#: Nicknames of given names; those quoted inside a name are learned from it directly.
NICKNAMES = {"ned": "edmund", "eddie": "edward", "ted": "theodore", "dolly": "dorothea", "nell": "eleanor", "flo": "florence", "gil": "gilbert", "georgie": "george", "hettie": "henrietta", "bella": "isabella", "jim": "james", "josie": "josephine", "kitty": "katherine", "kate": "katherine", "leo": "leopold", "maggie": "margaret", "peggy": "margaret", "nat": "nathaniel", "ollie": "oliver", "paddy": "patrick", "dick": "richard", "bob": "robert", "rosie": "rosamund", "sam": "samuel", "tom": "thomas", "tim": "timothy", "ursie": "ursula", "vicky": "victoria", "walt": "walter", "will": "william", "bill": "william", "winnie": "winifred", "ben": "benjamin", "bea": "beatrice", "trixie": "beatrice", "archie": "archibald", "gus": "augustus", "alex": "alexander", "sandy": "alexander", "charlie": "charles", "neil": "cornelius", "dan": "daniel", "fred": "frederick", "hal": "harriet", "hattie": "harriet", "sly": "sylvester", "vester": "sylvester", "addie": "adelaide"}

#: Wade-Giles initials and finals that differ from pinyin.
_INITIALS = (("ts'", "c"), ("tz'", "c"), ("ch'", "ch"), ("p'", "p"), ("t'", "t"), ("k'", "k"), ("ts", "z"), ("tz", "z"), ("ss", "s"), ("sz", "s"), ("ch", "zh"), ("hs", "x"), ("sh", "sh"), ("p", "b"), ("t", "d"), ("k", "g"), ("j", "r"))
_FINALS = {"ieh": "ie", "üeh": "ue", "ien": "ian", "ung": "ong", "iung": "iong", "uei": "ui", "ê": "e", "ên": "en", "êng": "eng", "üan": "uan", "ün": "un", "ü": "u", "ih": "i", "ŭ": "i", "û": "i"}
_ZERO = {"i": "yi", "yen": "yan", "yeh": "ye", "yu": "you", "yü": "yu", "yüan": "yuan", "yüeh": "yue", "yün": "yun", "yung": "yong", "o": "e", "erh": "er", "wei": "wei", "wên": "wen", "yin": "yin", "ying": "ying"}
_SYLLABLE = r"(?:zh|ch|sh|[bpmfdtnlgkhjqxrzcsyw])?(?:iong|iang|uang|ueng|iao|ian|ing|ong|uai|uan|ang|eng|ai|ei|ao|ou|an|en|in|un|ia|ie|iu|ua|uo|ui|ue|er|a|o|e|i|u)"
_PINYIN = re.compile(rf"(?:{_SYLLABLE})+")
_TWO = re.compile(rf"({_SYLLABLE})({_SYLLABLE})?({_SYLLABLE})?")


class Name(NamedTuple):
    kind: str  # c Chinese person, w Western person, f firm, s workshop, n pseudonym
    full: tuple[str, ...]
    short: tuple[str, ...]
    first: str = ""  # given name of a Western person, as far as known
    middle: str = ""


def bare(text: str) -> str:
    """Lower case without accents; apostrophes, hyphens and points kept."""
    if text.isascii():
        return text.lower()
    t = unicodedata.normalize("NFD", text.replace("’", "'").replace("‘", "'"))
    return "".join(c for c in t if not unicodedata.combining(c)).lower()


def from_wade(syllable: str) -> str | None:
    """Pinyin of one Wade-Giles syllable, None if it can't be one."""
    s = unicodedata.normalize("NFC", syllable.lower())
    if s in _ZERO:
        return _ZERO[s]
    head, rest = next(((p, s[len(w) :]) for w, p in _INITIALS if s.startswith(w)), ("", s))
    if not head:
        head, rest = (s[0], s[1:]) if s and s[0] in "mfnlhsyw" else ("", s)
    if not head and s[:1] not in tuple("aeioêü"):
        return None
    plain = _FINALS.get(rest, rest)
    if head in ("zh", "ch"):
        if rest == "ih":
            return head + "i"
        if rest[:1] in ("i", "ü"):
            head = "j" if head == "zh" else "q"
    if head in ("z", "c", "s") and rest in ("u", "ŭ", "û", "e") and s.startswith(("tz", "ss", "sz")):
        plain = "i"
    if plain == "o" and head in ("g", "k", "h"):
        plain = "e"
    elif plain == "o" and head in ("l", "d", "t", "n", "z", "c", "s", "zh", "ch", "r"):
        plain = "uo"
    out = bare(head + plain)
    return out if "ü" not in out and _PINYIN.fullmatch(out) and "'" not in out else None


def is_pinyin(form: str) -> bool:
    """Is every word of a form one or two pinyin syllables?"""
    return all((m := _TWO.fullmatch(w)) and not m[3] for w in form.split())


def initials(given: str) -> str:
    """First letters of the syllables of a pinyin given name."""
    m = _TWO.fullmatch(given)
    return "".join(g[0] for g in m.groups() if g) if m else given[:1]


def _chinese(words: list[str], comma: bool) -> Name | None:
    """A romanised Chinese name of two parts, either in pinyin or in Wade-Giles."""
    if len(words) != 2:
        return None
    plain = [bare(w).replace("'", "").replace("-", "") for w in words]
    dots = ["." in w for w in words]
    if any(dots):
        at = dots.index(True)
        letters = re.sub(r"[^a-z]", "", plain[at])
        other = plain[1 - at]
        if all(dots) or not (1 <= len(letters) <= 3) or not _PINYIN.fullmatch(other):
            return None
        return Name("c", (), (f"{other} {letters}",))
    full: dict[str, None] = {}
    short: dict[str, None] = {}

    def add(a: str, b: str) -> None:
        full[" ".join(sorted((a, b)))] = None
        for family, given in ((a, b), (b, a)):
            i = initials(given)
            if _PINYIN.fullmatch(given):
                short[f"{family} {i[:1]}"] = None
                if len(i) > 1:
                    short[f"{family} {i}"] = None

    wade = [w.lower() for w in words]
    if any("-" in w for w in wade):
        parts = [[from_wade(s) for s in w.split("-")] for w in wade]
        if all(all(p) for p in parts):
            add(*["".join(p) for p in parts])
    apart = any("'" in w or "-" in w and re.search("[üê]", unicodedata.normalize("NFC", w)) for w in wade)
    if not full or not apart and all(_PINYIN.fullmatch(w) for w in plain):
        add(*plain)
    return Name("c", tuple(full), tuple(short))


def _stem(word: str) -> str:
    """A word of a workshop's name: trade words and their abbreviations to one stem, places to pinyin."""
    w = bare(word)
    if "-" in w:
        parts = [from_wade(s) for s in unicodedata.normalize("NFC", word.lower().replace("’", "'")).split("-")]
        if all(parts):
            return "".join(parts)
    letters = re.sub(r"[^a-z]", "", w)
    if letters in TRADE:
        return TRADE[letters]
    if w.endswith(".") and len(letters) > 1:
        for t, stem in TRADE.items():
            if t[0] == letters[0] and _subsequence(letters, t):
                return stem
    return letters


def _subsequence(a: str, b: str) -> bool:
    at = iter(b)
    return all(c in at for c in a)


def _like(word: str, target: str) -> bool:
    """Within one edit, cheaply: for trade words with a typo."""
    if abs(len(word) - len(target)) > 1 or word[:1] != target[:1] and word[1:2] != target[1:2]:
        return False
    i = 0
    while i < min(len(word), len(target)) and word[i] == target[i]:
        i += 1
    a, b = word[i:], target[i:]
    return a[1:] == b or a == b[1:] or a[1:] == b[1:] or (len(a) > 1 and len(b) > 1 and a[0] == b[1] and a[1] == b[0] and a[2:] == b[2:])


def read(text: str | None) -> list[Name]:
    """All readings of a name; empty for NULL, empty or letterless texts. A name with a pseudonym or a Chinese form
    gives readings for each."""
    if not text:
        return []
    t = _ATTR.sub("", re.sub(r"\s+", " ", text).strip())
    out: list[Name] = []
    for part in re.findall(r"[(（]([^()（）]*)[)）]", t):
        if _HAO.match(part):
            out += [Name("n", (bare(_HAO.sub("", part)).strip(),), ())]
        elif part.strip():
            out += read(part)
    t = re.sub(r"[(（][^()（）]*[)）]?", " ", t)
    for run in _CJK.findall(t):
        out.append(Name("c", (run,), ()))
    t = re.sub(r"\s+", " ", _CJK.sub(" ", t)).strip(" ,;")
    if not re.search(r"[A-Za-zÀ-ɏ]", t):
        return out
    low = bare(t)
    messrs = re.match(r"messrs\.?\s+", low)
    if messrs or _FIRM.search(low) and re.search(r"&|\band\b|,", low):
        core = _FIRM.sub("", low[messrs.end() :] if messrs else low)
        names = [w for w in re.findall(r"[a-z'-]+", core) if w not in ("and", "the", "co")]
        if names:
            return [*out, Name("f", (" ".join(names),), ())]
    if _PSEUDONYM.search(low):
        return [*out, Name("n", (low,), ())]
    words = t.replace(",", " ").split()
    stems = [_stem(w) for w in words if bare(w).strip(".,") not in ("the", "of", "at")]
    stems = [next((x for y, x in TRADE.items() if len(s) > 4 and _like(s, y)), s) if s not in TRADE.values() else s for s in stems]
    if len(stems) > 1 and any(s in _TRADE_END for s in stems):
        return [*out, Name("s", (" ".join(sorted(stems)),), ())]
    nick = re.search(r'["“]([^"”]+)["”]', t)
    t = re.sub(r'["“][^"”]*["”]?', " ", t)
    family, comma, given = t.partition(",")
    words = [*family.split(), *given.split()]
    chinese = _chinese(words, bool(comma))
    if chinese and all(_PINYIN.fullmatch(w) for f in chinese.full for w in f.split()):
        return [*out, chinese]
    if comma:
        last, rest = bare(family).strip(), given.split()
    else:
        parts = t.split()
        last, rest = bare(parts[-1]), parts[:-1]
    if not rest:
        return [*out, Name("w", (last,), ())]
    rest = [x for r in rest for x in (re.findall(r"[^\W\d_]\.?", r) if re.fullmatch(r"(?:[^\W\d_]\.){2,}", r) else [r])]
    first = bare(rest[0])
    middle = bare(rest[1])[:1] if len(rest) > 1 else ""
    last = re.sub(r"[^a-z'-]", "", last)
    if len(first.strip(".")) == 1:
        w = Name("w", (), (f"{last} {first[0]}",), first[0], middle)
    else:
        letters = re.sub(r"[^a-z]", "", first)
        known = NICKNAMES.get(letters, letters)
        full = (f"{last} {known}",) if not first.endswith(".") else ()
        shorts = {f"{last} {known[0]}", f"{last} {letters[0]}"}
        w = Name("w", full, tuple(shorts), known + ("." if first.endswith(".") else ""), middle)
    if chinese and any(_PINYIN.fullmatch(x) for f in chinese.full for x in f.split()):
        return [*out, Name("c", chinese.full, chinese.short), w]
    return [*out, w]


def agree(a: Name, b: Name) -> bool:
    """Do given names and middle initials of two Western readings not contradict each other?"""
    if a.middle and b.middle and a.middle != b.middle:
        return False
    x, y = a.first, b.first
    if not x or not y or len(x) == 1 or len(y) == 1:
        return x[:1] == y[:1] or not x or not y
    if x.endswith(".") or y.endswith("."):
        s, t = sorted((x.rstrip("."), y.rstrip(".")), key=len)
        return _subsequence(s, t) and s[0] == t[0]
    return x == y or _like(x, y)
