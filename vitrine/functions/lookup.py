"""Reading what a lookup service returns about a maker, and cutting texts for a translation service."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.functions.text import c, let, strip
from vitrine.runtime import map_rows


def time_text(time: Column | str, precision: Column | str) -> Column:
    """A lookup's time by its precision: year (9 and less), month (10) or day (11); the sign is dropped."""
    day = lambda t: F.split_part(F.regexp_replace(t, r"^[+-]", ""), F.lit("T"), F.lit(1))
    def read(d: Column) -> Column:
        y, m = F.split_part(d, F.lit("-"), F.lit(1)), F.split_part(d, F.lit("-"), F.lit(2))
        return F.when(c(precision) >= 11, d).when(c(precision) == 10, F.concat(y, F.lit("-"), m)).otherwise(y)

    return F.when(strip(time) == "", "").otherwise(let(day(strip(time)), read))


def best_time(claims: Column | str) -> Column:
    """Of claims array<struct<rank, time, precision>> the preferred one's time, else the first's, else empty."""
    every = F.coalesce(c(claims), F.array())
    preferred = F.filter(every, lambda x: x["rank"] == "preferred")
    return let(F.coalesce(F.get(preferred, F.lit(0)), F.get(every, F.lit(0))), lambda x: F.when(x.isNull(), "").otherwise(time_text(x["time"], x["precision"])))


def is_human(instances: Column | str, human: str = "Q5") -> Column:
    """Does a lookup's list of classes hold "human"?"""
    return F.array_contains(F.coalesce(c(instances), F.array().cast("array<string>")), human)


def in_languages(texts: Column | str, languages: tuple[str, ...] = ("zh", "zh-cn", "zh-hans", "en")) -> Column:
    """First non-blank text of a map by language, in order of preference."""
    return F.coalesce(*[F.nullif(strip(F.element_at(c(texts), F.lit(k))), F.lit("")) for k in languages], F.lit(""))


def pieces(text: str, most: int = 4500) -> list[str]:
    """Pieces of at most ``most`` characters, cut after the last sentence, else at the last space, else hard."""
    out, rest = [], text
    while len(rest) > most:
        at = rest.rfind(". ", 0, most)
        at = at + 1 if at > 0 else rest.rfind(" ", 0, most)
        at = at if at > 0 else most
        out.append(rest[:at].strip())
        rest = rest[at:].strip()
    return [p for p in [*out, rest] if p]


def in_pieces(df: DataFrame, key: str, column: str, most: int = 4500) -> DataFrame:
    """(key, pos, piece) of every non-blank text, positions from 1."""

    def make() -> Callable[..., Iterable[tuple]]:
        def step(keys: list, texts: list) -> Iterable[tuple]:
            for k, t in zip(keys, texts):
                for pos, p in enumerate(pieces(t or "", most), 1):
                    yield k, pos, p

        return step

    kind = df.schema[key].dataType.simpleString()
    return map_rows(df.select(key, F.col(column).cast("string")), make, f"{key} {kind}, pos int, piece string")
