"""Variant spellings of one person, firm or workshop: a pigeonhole segment join over the forms of names.

Every name is read into forms (order, romanisation, abbreviations and nicknames normalised; see ``names``). A form is
cut into twelve segments. One edit spoils one of them, or two neighbours if a swap straddles a cut, and all others stay
whole; what is left without two neighbours is a key of the inverted index, looked up with the letters behind the gap
shifted by what an insertion or deletion moves. So a surname that many share is no key by itself. Candidates are verified by banded edit distance and by what else is
known: years, given names, middle initials. Names with a year meet only within that year, which also lets surname and
initials stand for a person; a name without years joins the nearest dated one only if there is no second as near.
Verified links make connected components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitrine.llm.canonical import osa
from vitrine.llm.names import Name, agree, is_pinyin, read
from vitrine.operators.components import components
from vitrine.runtime import cut, map_rows

#: Segments of a form (of a shorter one, as many as its letters); one edit spoils two neighbours at most.
SEGMENTS = 12
#: Forms shorter than this are cut into no segments: they meet by what is left of them without one letter, and only where
#: a year is known.
SHORTEST = 6


def _bounds(n: int) -> list[tuple[int, int]]:
    """The even cuts of a form of n characters."""
    m = min(SEGMENTS, n)
    cuts = [n * i // m for i in range(m + 1)]
    return list(zip(cuts, cuts[1:]))


def _key(*parts: object) -> int:
    return xxhash.xxh64_intdigest("\t".join(map(str, parts)).encode("utf-8", "surrogatepass")) - (1 << 63)


def shortened(form: str) -> set[str]:
    """A form without one of its letters, and itself: two forms within one edit have one of these in common."""
    if not form.isascii() or len(form) < 3:
        return set()  # a Chinese character is no slip of the pen
    return {form, *[form[:i] + form[i + 1 :] for i in range(len(form))]}


def index_keys(form: str, space: str) -> list[int]:
    """Keys of the inverted index: the form without two neighbouring segments, with their number and the form's length."""
    n = len(form)
    if n < SHORTEST:
        return [_key(space, form), *[_key(space, "-", x) for x in shortened(form)]]
    bounds = _bounds(n)
    return [_key(space, n, i, form[:a], form[b:]) for i, ((a, _), (_, b)) in enumerate(zip(bounds, bounds[1:]))]


def probe_keys(form: str, space: str, longer: bool) -> set[int]:
    """Keys under which the forms within one edit may be found: those of the same length, one shorter, and, if longer
    is set, one longer; behind the gap the letters are shifted by the difference."""
    n = len(form)
    out = {_key(space, form), *[_key(space, "-", x) for x in shortened(form)]} if n < SHORTEST + 1 else set()
    for length in (n, n - 1, n + 1) if longer else (n, n - 1):
        if length >= SHORTEST:
            bounds = _bounds(length)
            out.update(_key(space, length, i, form[:a], form[b + n - length :]) for i, ((a, _), (_, b)) in enumerate(zip(bounds, bounds[1:])))
    return out


def distance(a: list[Name], b: list[Name], dated: bool) -> float | None:
    """How far two names are apart: 0 if they share a form, 1 if forms differ by one edit, -0.5 for one Chinese writing;
    None if nothing links them. Short forms count only between names of one year."""
    best: float | None = None
    for x in a:
        for y in b:
            if x.kind != y.kind or x.kind == "w" and not agree(x, y):
                continue
            for f in x.full:
                for g in y.full:
                    d = osa(f, g, 1) if min(len(f), len(g)) >= SHORTEST or dated and f.isascii() and min(len(f), len(g)) >= 3 else float(f != g) * 2
                    if d == 1 and not dated and x.kind == "c" and is_pinyin(f) and is_pinyin(g):
                        continue  # two real names that are one letter apart, and no year to say they are one
                    if d <= 1:
                        d = -0.5 if d == 0 and not f.isascii() else d
                        best = d if best is None else min(best, d)
            if dated and best is None:
                for f in x.short:
                    for g in y.short:
                        if f == g or x.kind == "w" and f[-1] == g[-1] and osa(f, g, 1) <= 1:
                            best = 1.0
    return best


def links(names: DataFrame, key: str = "alias_id") -> DataFrame:
    """Verified links (a, b, d, births) between names(key, alias, birth_year, death_year), each pair once or more; births is
    the number of ends whose year is known."""

    def make_keys() -> Callable[..., Iterable[tuple]]:
        def step(ids: list, texts: list, births: list) -> Iterable[tuple]:
            for i, text, birth in zip(ids, texts, births):
                index: set[int] = set()
                probes: set[int] = set()
                for name in read(text):
                    for form in name.full:
                        if birth is not None:
                            space = f"{name.kind}{birth}"
                            index.update(index_keys(form, space))
                            probes |= probe_keys(form, space, False)
                        else:
                            probes |= probe_keys(form, name.kind, True)
                        index.update(index_keys(form, name.kind))
                    if birth is not None:
                        for form in name.short:
                            space = f"{name.kind}-{birth}"
                            if name.kind == "w":
                                index.update(index_keys(form, space))
                                probes |= probe_keys(form, space, False)
                            else:
                                index.add(_key(space, form))
                                probes.add(_key(space, form))
                for k in index:
                    yield 0, k, i
                for k in probes:
                    yield 1, k, i

        return step

    kind = names.schema[key].dataType.simpleString()
    rows = names.select(F.col(key).alias("id"), F.col("alias").cast("string").alias("alias"), F.col("birth_year").cast("int").alias("birth"), F.col("death_year").cast("int").alias("death"))
    keys = cut(map_rows(rows.select("id", "alias", "birth"), make_keys, f"side int, k long, id {kind}"))
    index = keys.where("side = 0").select("k", F.col("id").alias("b"))
    pairs = keys.where("side = 1").select("k", F.col("id").alias("a")).join(index, "k").where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    left = rows.select(F.col("id").alias("a"), F.col("alias").alias("x"), F.col("birth").alias("x_birth"), F.col("death").alias("x_death"))
    right = rows.select(F.col("id").alias("b"), F.col("alias").alias("y"), F.col("birth").alias("y_birth"), F.col("death").alias("y_death"))
    full = pairs.join(left, "a").join(right, "b").where("(x_birth IS NULL OR y_birth IS NULL OR x_birth = y_birth) AND (x_death IS NULL OR y_death IS NULL OR x_death = y_death)")

    def make_checks() -> Callable[..., Iterable[tuple]]:
        known: dict[str, list[Name]] = {}

        def reading(t: str) -> list[Name]:
            if t not in known:
                if len(known) > 50_000:
                    known.clear()
                known[t] = read(t)
            return known[t]

        def step(a: list, b: list, x: list, y: list, known: list) -> Iterable[tuple]:
            for i, j, s, t, births in zip(a, b, x, y, known):
                d = distance(reading(s), reading(t), births == 2)
                if d is not None:
                    yield i, j, float(d), births

        return step

    births = F.expr("int(x_birth IS NOT NULL) + int(y_birth IS NOT NULL)")
    return map_rows(full.select("a", "b", "x", "y", births.alias("births")), make_checks, f"a {kind}, b {kind}, d double, births int")


def _notes(names: DataFrame, key: str) -> DataFrame:
    """Per name (node, birth): whether it has a full form, its short forms and its middle initial; full is NULL for what
    is no name."""

    def make() -> Callable[..., Iterable[tuple]]:
        def step(ids: list, texts: list, births: list) -> Iterable[tuple]:
            for i, text, birth in zip(ids, texts, births):
                got = read(text)
                if got:
                    yield i, birth, any(n.full for n in got), sorted({s for n in got if n.kind in "cw" for s in n.short}), max((n.middle for n in got), default="")
                elif birth is not None:
                    yield i, birth, None, [], ""

        return step

    kind = names.schema[key].dataType.simpleString()
    rows = names.select(F.col(key).alias("id"), F.col("alias").cast("string"), F.col("birth_year").cast("int"))
    return map_rows(rows, make, f"node {kind}, birth int, full boolean, short array<string>, middle string")


def clusters(names: DataFrame, key: str = "alias_id") -> DataFrame:
    """(key, cluster) for every name that has variants.

    NULL, empty and letterless names have none; names equal in every form and year are variants of each other; a name
    without years that is equally near to two dated ones stays alone; an empty table gives no rows; columns that aren't
    named are ignored.
    """
    found = cut(links(names, key))
    dated = components(found.where("births = 2"))
    # every name with its home: the cluster of dated names it stands in, or itself
    nodes = _notes(names, key).join(dated, "node", "left")
    nodes = cut(nodes.withColumn("home", F.when(F.col("birth").isNotNull(), F.coalesce("component", "node"))).drop("component"))
    homes = nodes.where("birth IS NOT NULL")
    bare = nodes.where("birth IS NULL AND full IS NOT NULL")
    # homes near a name without years, by the middle initials they allow
    middles = homes.where("middle <> ''").groupBy("home").agg(F.collect_set("middle").alias("middles"))
    mixed = found.where("births = 1")
    either = mixed.select(F.col("a").alias("n"), F.col("b").alias("node"), "d").unionByName(mixed.select(F.col("b").alias("n"), F.col("a").alias("node"), "d"))
    near = either.join(homes.select("node", "home", "birth"), "node").groupBy("n", "home", "birth").agg(F.min("d").alias("d"))
    near = near.join(middles, "home", "left").join(bare.select(F.col("node").alias("n"), "middle"), "n", "left")
    near = near.where("middles IS NULL OR coalesce(middle, '') = '' OR array_contains(middles, middle)")
    # all homes as near as the nearest, if they are of one year
    of_name = Window.partitionBy("n")
    close = near.withColumn("least", F.min("d").over(of_name)).where(F.col("d") <= F.greatest("least", F.lit(0.0)))
    near = cut(close.withColumn("one_year", F.min("birth").over(of_name) == F.max("birth").over(of_name)).select("n", "home", "one_year"))
    joined = near.where("one_year").select(F.col("n").alias("a"), F.col("home").alias("b"))
    claimed = near.select("n").distinct()
    # names without years that no dated name claims, among themselves
    free = found.where("births = 0")
    for end in ("a", "b"):
        free = free.join(claimed.withColumnRenamed("n", end), end, "left_anti")
    groups = components(free)
    lonely = bare.where("full").join(claimed.withColumnRenamed("n", "node"), "node", "left_anti").join(groups, "node", "left")
    lonely = cut(lonely.select("node", "short", "middle", F.coalesce("component", "node").alias("group")))
    # dated names of initials only, which no dated full name claims, and undated full names: each the other's only one
    unowned = homes.groupBy("home").agg(F.max(F.coalesce("full", F.lit(False))).alias("owned")).where("NOT owned").select("home")
    initials = homes.where("full IS NOT NULL").join(unowned, "home", "left_semi").select("home", F.explode("short").alias("s"), "middle")
    spelled = lonely.select("group", F.explode("short").alias("s"), F.col("middle").alias("m"))
    meet = cut(initials.join(spelled, "s").where("middle = '' OR m = '' OR middle = m").select("home", "group").distinct())
    one = meet.groupBy("group").agg(F.count("*").alias("n"), F.min("home").alias("home")).where("n = 1").join(meet.groupBy("home").agg(F.count("*").alias("k")).where("k = 1"), "home")
    # homes that undated names hold together, also over other homes, become the smallest of them
    pick = cut(joined.groupBy("a").agg(F.min("b").alias("to")))
    merged = components(joined.join(pick, "a").where("b <> to").select("to", "b").distinct(), "to", "b").select(F.col("node").alias("home"), F.col("component").alias("to"))
    at_home = homes.select("node", "home").unionByName(pick.select(F.col("a").alias("node"), F.col("to").alias("home")))
    rest = lonely.join(one.select("group", F.col("home").alias("own")), "group", "left").select("node", F.coalesce("own", "group").alias("home"))
    every = cut(at_home.unionByName(rest).join(merged, "home", "left").select("node", F.coalesce("to", "home").alias("component")))
    many = every.groupBy("component").agg(F.count("*").alias("n")).where("n > 1").select("component")
    return every.join(many, "component", "left_semi").select(F.col("node").alias(key), F.col("component").alias("cluster"))


def variant_pairs(names: DataFrame, key: str = "alias_id") -> DataFrame:
    """Every pair (key_a, key_b) of variants, key_a < key_b. A cluster is one entity's spellings, which bounds its pairs."""
    c = cut(clusters(names, key))
    a, b = c.withColumnRenamed(key, f"{key}_a"), c.withColumnRenamed(key, f"{key}_b")
    return a.join(b, "cluster").where(F.col(f"{key}_a") < F.col(f"{key}_b")).select(f"{key}_a", f"{key}_b")
