"""Dates, years and eras out of free texts, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitrine.functions.text import c, let, strip

#: Eras by year, negative before the common era; the order decides ties.
ERAS = (
    ("Neolithic", "新石器时代", -5000, -2000), ("Shang", "商", -1600, -1046), ("Zhou", "周", -1046, -256), ("Spring and Autumn", "春秋", -770, -476), ("Warring States", "战国", -475, -221), ("Qin", "秦", -221, -206),
    ("Western Han", "西汉", -206, 8), ("Xin", "新", 9, 23), ("Eastern Han", "东汉", 25, 220), ("Three Kingdoms", "三国", 220, 280), ("Western Jin", "西晋", 265, 316), ("Eastern Jin", "东晋", 317, 420), ("Northern and Southern", "南北朝", 420, 589),
    ("Sui", "隋", 581, 618), ("Tang", "唐", 618, 907), ("Five Dynasties", "五代", 907, 960), ("Liao", "辽", 916, 1125), ("Northern Song", "北宋", 960, 1127), ("Southern Song", "南宋", 1127, 1279), ("Jin", "金", 1115, 1234),
    ("Yuan", "元", 1271, 1368), ("Ming", "明", 1368, 1644), ("Qing", "清", 1644, 1911), ("Republic", "民国", 1912, 1949),
)
#: Names looked for in texts.
NAMES = (
    ("Neolithic", "新石器时代"), ("Shang", "商"), ("Zhou", "周"), ("Spring and Autumn", "春秋"), ("Warring States", "战国"), ("Western Han", "西汉"), ("Eastern Han", "东汉"), ("Three Kingdoms", "三国"), ("Northern and Southern", "南北朝"), ("Northern Song", "北宋"),
    ("Southern Song", "南宋"), ("Five Dynasties", "五代"), ("Qin", "秦"), ("Han", "汉"), ("Jin", "晋"), ("Sui", "隋"), ("Tang", "唐"), ("Liao", "辽"), ("Song", "宋"), ("Yuan", "元"), ("Ming", "明"), ("Qing", "清"), ("Republic", "民国"),
)
#: Words for which the text beats the years.
CULTURES = "neolithic|yangshao|longshan|liangzhu|majiayao|banpo|hongshan|dawenkou"
_FIRST = {"Tang", "Ming", "Qing", "Han", "Yuan", "Sui", "Qin", "Zhou", "Shang"}
_LAST = {"Jin", "Liao", "Five Dynasties", "Three Kingdoms"}
_BEFORE = r"(?i)B\.?\s*C\.?|BCE|BC|公元前"


def shown(en: str, zh: str) -> str:
    return f"{en}（{zh}）"


def _rank(en: str) -> int:
    """Which era the midpoint of a long interval prefers."""
    return 0 if "Song" in en else 1 if en in _FIRST else 3 if en in _LAST else 2


def iso_date(x: Column | str) -> Column:
    """A year, a month or a time as a date; years before the common era padded; anything else as it is."""

    def read(t: Column) -> Column:
        out = F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}$"), t).when(t.rlike(r"^\d{4}$"), F.concat(t, F.lit("-01-01"))).when(t.rlike(r"^\d{4}-\d{2}$"), F.concat(t, F.lit("-01")))
        out = out.when(t.rlike(r"^-\d{1,4}$"), F.concat(F.lit("-"), F.lpad(F.substring(t, 2, 4), 4, "0"), F.lit("-01-01")))
        return out.when((F.length(t) >= 10) & (F.substring(t, 5, 1) == "-") & (F.substring(t, 8, 1) == "-"), F.substring(t, 1, 10)).otherwise(t)

    return let(strip(x), read)


def _year(token: Column) -> Column:
    """First number of a token, negative where the token says so."""
    return let(F.nullif(F.regexp_extract(token, r"(-?\d{1,4})", 1), F.lit("")).cast("int"), lambda n: F.when(token.rlike(_BEFORE) & (n > 0), -n).otherwise(n))


def _pair(s: Column, e: Column) -> Column:
    return F.struct(s.cast("int").alias("start"), e.cast("int").alias("end"))


def period_years(x: Column | str) -> Column:
    """struct(start, end) of a free-text period, both NULL if it can't be read.

    In this order: the first two tokens around a dash, unless the text speaks of centuries; one year; centuries; decades.
    """

    def dash(t: Column) -> Column:
        span = r"(?i)([\d\s,BCEbc.\-]+?)\s*[-–—]\s*([\d\s,BCEbc.\-]+)"
        before = t.rlike(_BEFORE) & ~t.rlike(r"(?i)(?<!B)C\.?\s*E\.|(?<!B)\bCE\b|AD|公元(?!前)")
        ends = F.struct(_year(F.regexp_extract(t, span, 1)).alias("a"), _year(F.regexp_extract(t, span, 2)).alias("b"), before.alias("n"))
        signed = let(ends, lambda p: F.struct(F.when(p["n"], -F.abs(p["a"])).otherwise(p["a"]).alias("a"), F.when(p["n"], -F.abs(p["b"])).otherwise(p["b"]).alias("b")))
        return let(signed, lambda p: F.when(p["a"].isNotNull() & p["b"].isNotNull(), _pair(F.least(p["a"], p["b"]), F.greatest(p["a"], p["b"]))))

    def single(t: Column) -> Column:
        some = r"(?i)(\d{3,4})\s*(B\.?\s*C\.?|BCE|BC|公元前)?"
        whole = F.regexp_replace(t, "公元前", "BCE").rlike(r"(?i)^[\d\s,BCEbc.\-]+$")
        loose = let(F.nullif(F.regexp_extract(t, some, 1), F.lit("")).cast("int"), lambda n: F.when(F.regexp_extract(t, some, 2) != "", -n).otherwise(n))
        year = F.coalesce(F.when(whole, _year(t)), F.when(~t.rlike(r"\d+\s*[-–]\s*\d+"), loose))
        return let(year, lambda y: F.when(y.isNotNull(), _pair(y, y)))

    def centuries(t: Column) -> Column:
        n = F.transform(F.regexp_extract_all(t, F.lit(r"(?i)(?:(?:early|late|mid(?:dle)?)\s+)?(\d{1,2})(?:st|nd|rd|th)\s+century"), 1), lambda d: d.cast("int"))
        before = t.rlike(r"(?i)\bB\.?\s*C\.?|BCE|BC|公元前")
        both = let(n, lambda d: F.when(F.size(d) > 0, F.struct(((F.array_min(d) - 1) * 100 + 1).alias("a"), (F.array_max(d) * 100).alias("b"))))
        return let(both, lambda p: F.when(p.isNotNull(), F.when(before, _pair(-p["b"], -p["a"])).otherwise(_pair(p["a"], p["b"]))))

    def decades(t: Column) -> Column:
        n = F.transform(F.regexp_extract_all(t, F.lit(r"(?i)(?:early|late|mid)?\s*(\d{3,4})s\b"), 1), lambda d: d.cast("int"))
        return let(n, lambda d: F.when(F.size(d) > 0, _pair(F.floor(F.array_min(d) / 100) * 100, F.floor(F.array_max(d) / 100) * 100 + 99)))

    def read(t: Column) -> Column:
        plain = ~t.rlike("(?i)century")
        return F.coalesce(F.when(plain, dash(t)), F.when(plain, single(t)), centuries(t), decades(t), _pair(F.lit(None), F.lit(None)))

    return let(strip(x), read)


def era_of_years(start: Column | str, end: Column | str) -> Column:
    """Era of an interval of years, shown as "English（中文）", empty if none.

    Up to 80 years the longest overlap wins, then the shorter era, then the earlier in the list; beyond, the era that
    holds the midpoint, by preference, then the shorter. Only the 24 rows of the list are compared, as an expression.
    """

    def pick(p: Column) -> Column:
        s, e, mid = p["s"], p["e"], p["m"]
        near, wide = [], []
        for i, (en, zh, a, b) in enumerate(ERAS):
            rest = (F.lit(a - b).alias("n"), F.lit(-i).alias("i"), F.lit(shown(en, zh)).alias("v"))
            near.append(F.struct(F.greatest(F.lit(0), F.least(e, F.lit(b)) - F.greatest(s, F.lit(a)) + 1).alias("o"), *rest))
            wide.append(F.when((mid >= a) & (mid <= b), F.struct(F.lit(-_rank(en)).alias("o"), *rest)))
        best = F.array_max(F.filter(F.array(*near), lambda r: r["o"] > 0))["v"]
        return F.coalesce(F.when(e - s + 1 > 80, F.array_max(F.array_compact(F.array(*wide)))["v"]).otherwise(best), F.lit(""))

    ends = F.struct(c(start).alias("a"), F.coalesce(c(end), c(start)).alias("b"))
    ordered = let(ends, lambda p: F.struct(F.least(p["a"], p["b"]).alias("s"), F.greatest(p["a"], p["b"]).alias("e"), F.floor((p["a"] + p["b"]) / 2).alias("m")))
    return let(ordered, pick)


def era_of_text(x: Column | str) -> Column:
    """Era named in a text: names of several words anywhere, then single words, then Chinese names; longer ones first."""

    def read(p: Column) -> Column:
        t, low = p["t"], p["l"]
        longest = lambda names, at: sorted(names, key=lambda n: -len(n[at]))
        cases = [(low.contains(en.lower()), en, zh) for en, zh in longest([n for n in NAMES if " " in n[0]], 0)]
        cases += [(low.rlike(rf"(?U)\b{en.lower()}\b"), en, zh) for en, zh in longest([n for n in NAMES if " " not in n[0]], 0)]
        cases += [(t.contains(zh), en, zh) for en, zh in longest(NAMES, 1)]
        out = F.when(t == "", "")
        for test, en, zh in cases:
            out = out.when(test, shown(en, zh))
        return out.otherwise("")

    return let(strip(x), lambda t: let(F.struct(t.alias("t"), F.lower(t).alias("l")), read))


def era(period: Column | str, start: Column | str, end: Column | str) -> Column:
    """Era of a record: the text where it names an early culture, else the years (given or read), else the text."""
    given = F.struct(c(start).alias("start"), F.coalesce(c(end), c(start)).alias("end"))
    years = F.when(c(start).isNull() & c(end).isNull(), period_years(period)).otherwise(given)
    both = F.struct(era_of_text(period).alias("t"), let(years, lambda y: F.when(y["start"].isNotNull() & y["end"].isNotNull(), era_of_years(y["start"], y["end"])).otherwise("")).alias("y"))
    early = F.lower(strip(period)).rlike(CULTURES)
    return let(both, lambda b: F.when((b["t"] != "") & early, b["t"]).when(b["y"] != "", b["y"]).otherwise(b["t"]))


def year_zh(y: Column | str) -> Column:
    return F.when(c(y) < 0, F.concat(F.lit("公元前"), F.abs(c(y)).cast("string"), F.lit("年"))).otherwise(F.concat(c(y).cast("string"), F.lit("年")))


def period_shown(period: Column | str, start: Column | str, end: Column | str) -> Column:
    """The period with its years in Chinese behind it."""
    s, e = c(start), c(end)
    years = F.when(s.isNotNull() & e.isNotNull() & (s != e), F.concat(year_zh(s), F.lit("-"), year_zh(e))).otherwise(year_zh(F.coalesce(s, e)))
    t = strip(period)
    return F.when(F.coalesce(s, e).isNull(), t).when(t == "", years).otherwise(F.concat(t, F.lit(" ["), years, F.lit("]")))
