"""Quantities in different units: find unit aliases by one automaton, tie them to numbers, convert by a joined table.

An Aho-Corasick automaton over all aliases of all units scans each text once (leftmost, longest match: "mm" beats "m",
"inches" beats "in"). An alias counts only where it directly follows a number; a number without a unit takes the unit
that closes its group ("10 x 20 cm"); feet/inches and pounds/ounces that follow each other make one quantity. What is
found are (unit, value) pairs; the conversion to the common unit is a join with the table of factors, whose size is
that of the fixed list below and which is therefore broadcast.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.runtime import map_rows

#: Unit, common unit, factor, aliases.
UNITS = (
    ("mm", "mm", "1", "mm millimeter millimeters millimetre millimetres 毫米 公厘"),
    ("cm", "mm", "10", "cm centimeter centimeters centimetre centimetres 厘米 公分"),
    ("dm", "mm", "100", "dm decimeter decimeters decimetre decimetres 分米"),
    ("m", "mm", "1000", "m meter meters metre metres 米 公尺"),
    ("in", "mm", "25.4", "in inch inches \" ″ ” '' 英寸 吋"),
    ("ft", "mm", "304.8", "ft foot feet ' ′ ’ 英尺 呎"),
    ("yd", "mm", "914.4", "yd yard yards 码"),
    ("mg", "g", "0.001", "mg milligram milligrams 毫克"),
    ("g", "g", "1", "g gr gm gram grams gramme grammes 克 公克"),
    ("kg", "g", "1000", "kg kgs kilo kilos kilogram kilograms kilogramme kilogrammes 公斤 千克"),
    ("oz", "g", "28.349523125", "oz ounce ounces 盎司"),
    ("lb", "g", "453.59237", "lb lbs pound pounds 磅"),
)
#: Units that may follow each other in one quantity.
COMPOUND = {("ft", "in"), ("yd", "ft"), ("lb", "oz"), ("m", "cm"), ("kg", "g")}
#: Vulgar fractions.
FRACTIONS = {"¼": 0.25, "½": 0.5, "¾": 0.75, "⅐": 1 / 7, "⅑": 1 / 9, "⅒": 0.1, "⅓": 1 / 3, "⅔": 2 / 3, "⅕": 0.2, "⅖": 0.4, "⅗": 0.6, "⅘": 0.8, "⅙": 1 / 6, "⅚": 5 / 6, "⅛": 0.125, "⅜": 0.375, "⅝": 0.625, "⅞": 0.875}

_VULGAR = "".join(FRACTIONS)
_NUMBER = re.compile(rf"(?<![\d.,/])(?:(\d+)[/⁄](\d+)|(\d+)(?:(?:\s+|-)(\d+)[/⁄](\d+)|\s?([{_VULGAR}]))|([{_VULGAR}])|(\d{{1,3}}(?:,\d{{3}})+\.\d+|\d+[.,]\d+|\d*\.\d+|\d+))")
_BRACKETS = re.compile(r"\([^()]*(?:\)|$)|（[^（）]*(?:）|$)|\[[^\[\]]*(?:\]|$)")
_AFTER = re.compile(r"\.?\s*[x×*]\s*(?:\d|[a-z]{1,8}[.:]?\s*\d|[hwdl][.:])", re.I)
_BREAK = re.compile(r"[;；]|重|\b(?:weight|wt|weighs)\b", re.I)


def automaton():  # noqa: ANN201
    """The automaton of all aliases; a value is (length, unit)."""
    import ahocorasick  # noqa: PLC0415

    a = ahocorasick.Automaton()
    for unit, _, _, aliases in UNITS:
        for alias in aliases.split():
            a.add_word(alias, (len(alias), unit))
    a.make_automaton()
    return a


def _value(m: re.Match, unit: str) -> float | None:
    top, below, whole, top2, below2, vulgar, alone, plain = m.groups()
    try:
        if top:
            return int(top) / int(below)
        if top2:
            return int(whole) + int(top2) / int(below2)
        if whole:
            return int(whole) + FRACTIONS[vulgar]
        if alone:
            return FRACTIONS[alone]
        if "," in plain:
            thousands = "." in plain or len(plain.rpartition(",")[2]) == 3 and unit not in ("m", "kg", "lb", "yd")
            plain = plain.replace(",", "" if thousands else ".")
        return float(plain)
    except (ZeroDivisionError, OverflowError):
        return None


def quantities(text: str, units) -> list[tuple[str, float, str | None, float | None]]:  # noqa: ANN001
    """(unit, value, second unit, second value) of every measured quantity, in the order of the text."""
    lower = text.lower()
    lower = lower if len(lower) == len(text) else text
    outside = _BRACKETS.sub(lambda m: " " * len(m[0]), lower)
    if re.search(r"\d", outside) or _VULGAR and re.search(f"[{_VULGAR}]", outside):
        lower = outside
    starts = {end - size + 1: (end + 1, unit) for end, (size, unit) in units.iter_long(lower)}
    out: list[tuple[str, float, str | None, float | None]] = []
    pending: list[re.Match] = []
    last, at, joined = "", 0, False
    for m in _NUMBER.finditer(lower):
        gap = lower[at : m.start()]
        if _BREAK.search(gap):
            pending, last = [], ""
        follow = m.end()
        while follow < len(lower) and lower[follow] in "  ":
            follow += 1
        end, unit = starts.get(follow, (0, ""))
        if unit and unit.isascii() and lower[end - 1].isalpha() and lower[end - 1].isascii():
            rest = lower[end : end + 16]
            if rest[:1].isalpha() and rest[0].isascii() and not _AFTER.match(rest):
                unit = ""
        if unit:
            at = end
            same = last and not joined and not pending and (last, unit) in COMPOUND and not gap.strip(" .  ") and out and out[-1][2] is None
            if same and (v := _value(m, unit)) is not None:
                out[-1] = (*out[-1][:2], unit, v)
                last, joined = unit, True
                continue
            for p in pending:
                if (v := _value(p, unit)) is not None:
                    out.append((unit, v, None, None))
            if (v := _value(m, unit)) is not None:
                out.append((unit, v, None, None))
            pending, last, joined = [], unit, False
        else:
            at = m.end()
            if lower[m.end() : m.end() + 1] not in (":", "："):
                pending.append(m)
            last = ""
    return out


def measured(df: DataFrame, key: str = "seq", column: str = "dimensions", digits: int = 0) -> DataFrame:
    """One row (key, pos, unit, amount) per measured quantity in common units (mm, g), rounded half up.

    NULL and empty texts and texts without any unit give no rows; numbers that no unit closes are skipped and not
    counted; an amount that no whole number of 64 bits holds is NULL; brackets restate what stands before them and are skipped unless the text has no number outside them; equal
    quantities are kept; other columns of ``df`` are ignored; whole texts are scanned whatever their length.
    """

    def make() -> Callable[..., Iterable[tuple]]:
        units = automaton()

        def step(keys: list, texts: list) -> Iterable[tuple]:
            for k, text in zip(keys, texts):
                for pos, (u, v, u2, v2) in enumerate(quantities(text, units), 1):
                    yield k, pos, u, v, u2, v2

        return step

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("key"), F.col(column).cast("string").alias("text")).where(F.col("text").rlike(f"[0-9{_VULGAR}]"))
    found = map_rows(rows, make, f"key {kind}, pos int, u1 string, v1 double, u2 string, v2 double")
    factors = df.sparkSession.createDataFrame([u[:3] for u in UNITS], "alias string, common string, factor string").withColumn("factor", F.col("factor").cast("decimal(14,9)"))
    first = F.broadcast(factors.select(F.col("alias").alias("u1"), F.col("common").alias("unit"), F.col("factor").alias("f1")))
    second = F.broadcast(factors.select(F.col("alias").alias("u2"), F.col("factor").alias("f2")))
    # a number that the exact type can't hold is taken as a double, so that one bad cell stops no job
    exact = lambda v, f: F.col(v).try_cast("decimal(18,6)") * F.col(f)
    rough = lambda v, f: F.col(v) * F.col(f).cast("double")
    second_part = F.when(F.col("v2").isNull(), F.lit(0)).otherwise(exact("v2", "f2"))
    kind_of = "long" if digits == 0 else "double"
    whole = F.round(exact("v1", "f1") + second_part, digits).try_cast(kind_of)
    amount = F.coalesce(whole, F.round(rough("v1", "f1") + F.coalesce(rough("v2", "f2"), F.lit(0.0)), digits).try_cast(kind_of))
    out = found.join(first, "u1").join(second, "u2", "left")
    return out.select(F.col("key").alias(key), "pos", "unit", amount.alias("amount"))
