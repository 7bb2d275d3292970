"""Change detection, fingerprints and upserts between a stored table and an incoming one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.functions.text import strip
from vitrine.schema import COLUMNS, UNTRACKED


def fingerprint(columns: list[str] | None = None) -> Column:
    """SHA-256 of the tracked columns as compact JSON, keys sorted, NULL as empty text."""
    columns = sorted(columns or [c for c in COLUMNS if c not in UNTRACKED])
    return F.sha2(F.to_json(F.struct(*[strip(c).alias(c) for c in columns])), 256)


def first_of(df: DataFrame, key: str, order: str | None) -> DataFrame:
    """First row of each key, by order or, without one, by content."""
    by = F.col(order) if order else F.struct(*df.columns)
    return df.groupBy(key).agg(F.min_by(F.struct(*[c for c in df.columns if c != key]), by).alias("__r")).select(key, "__r.*").select(*df.columns)


def diff(old: DataFrame, new: DataFrame, key: str, columns: list[str], old_order: str | None = None, new_order: str | None = None) -> DataFrame:
    """(key, change_type, changed_fields) of every incoming row: new, updated, unchanged; skipped for a blank key.

    Texts are compared stripped, NULL as empty. Of several stored or incoming rows of one key the first counts. Rows
    only stored give none; either side may be empty.
    """
    cell = lambda c: strip(F.col(c))
    stored = first_of(old.where(cell(key) != ""), key, old_order).select(cell(key).alias("__k"), F.struct(*[cell(c).alias(c) for c in columns]).alias("o"), F.lit(True).alias("there"))
    good = first_of(new.where(cell(key) != ""), key, new_order).select(cell(key).alias("__k"), F.struct(*[cell(c).alias(c) for c in columns]).alias("n"))
    joined = good.join(stored, "__k", "left")
    changed = F.array_compact(F.array(*[F.when(F.col(f"n.{c}") != F.col(f"o.{c}"), F.lit(c)) for c in columns]))
    fresh = F.col("there").isNull()
    kind = F.when(fresh, "new").when(F.size(changed) > 0, "updated").otherwise("unchanged")
    out = joined.select(F.col("__k").alias(key), kind.alias("change_type"), F.when(fresh, F.array(*map(F.lit, columns))).otherwise(changed).alias("changed_fields"))
    blank = new.where(cell(key) == "").select(F.lit("").alias(key), F.lit("skipped").alias("change_type"), F.array().cast("array<string>").alias("changed_fields"))
    return out.unionByName(blank)


def upsert(old: DataFrame, new: DataFrame, keys: list[str], order: str | None = None, fill: bool = False) -> DataFrame:
    """old with the rows of new put in by key: the last of a key wins, and replaces the whole row; with ``fill``, only
    blank columns of the stored row are filled. Rows with a NULL key are kept as they are."""
    columns = old.columns
    by = F.col(order) if order else F.struct(*columns)
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    rest = [c for c in columns if c not in keys]
    last = new.where(known).groupBy(*keys).agg(F.max_by(F.struct(*rest), by).alias("__n"))
    joined = old.where(known).join(last, keys, "full_outer").withColumn("__old", F.struct(*rest)) if not fill else old.where(known).join(last, keys, "full_outer")
    if fill:
        value = lambda c: F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) == "", F.coalesce(F.col(f"__n.{c}"), F.col(c))).otherwise(F.col(c))
    else:
        value = lambda c: F.when(F.col("__n").isNotNull(), F.col(f"__n.{c}")).otherwise(F.col(c))
    merged = joined.select(*[value(c).alias(c) if c in rest else F.col(c) for c in columns])
    return merged.unionByName(old.where(~known)).unionByName(new.select(*columns).where(~known))


def backfill(df: DataFrame, values: DataFrame, keys: list[str], column: str) -> DataFrame:
    """df with ``column`` taken from values where there is one; of several the largest."""
    one = values.groupBy(*keys).agg(F.max(column).alias("__v"))
    return df.join(one, keys, "left").withColumn(column, F.coalesce("__v", column)).select(*df.columns)


def unseen(new: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    return new.join(known.select(*keys).distinct(), keys, "left_anti").select(*new.columns)


def watermark(df: DataFrame, column: str = "source_updated_at") -> DataFrame:
    """One row: the largest non-blank value, compared as text, empty if there is none."""
    return df.agg(F.coalesce(F.max(F.nullif(F.trim(column), F.lit(""))), F.lit("")).alias("watermark"))


def since(df: DataFrame, mark: str, column: str = "source_updated_at") -> DataFrame:
    """Rows later than the mark; rows without a value always pass, and so does everything with an empty mark."""
    v = F.coalesce(F.trim(F.col(column).cast("string")), F.lit(""))
    return df.where((v == "") | (v > mark))


#: Orders that share one stretch of the scan for the last known value.
STRETCH_BITS = 16


def last_known(df: DataFrame, partition: str | list[str], value: str, order: str, sub: str | None = None) -> DataFrame:
    """df with ``known``: the row's own value, else the last one of its partition before it; blank values are none.

    The order, a whole number, is cut into stretches. The last value of every stretch of a key is pre-aggregated, what a
    stretch inherits is looked up among the few stretches of its key, and rows are scanned inside their stretch only, so
    a key that holds a large share of the rows is spread over many tasks. ``sub`` orders rows of one order. A NULL
    partition is a key like any other; an empty table gives no rows.
    """
    keys = [partition] if isinstance(partition, str) else partition
    at = F.struct(order, sub) if sub else F.struct(order)
    own = F.nullif(F.col(value).cast("string"), F.lit(""))
    rows = df.withColumns({"__v": own, "__s": F.shiftright(F.col(order).cast("long"), STRETCH_BITS), **{f"__p{i}": F.coalesce(F.col(k).cast("string"), F.lit("\0")) for i, k in enumerate(keys)}})
    names = [f"__p{i}" for i in range(len(keys))]
    ends = rows.groupBy(*names, "__s").agg(F.max_by("__v", F.when(F.col("__v").isNotNull(), at)).alias("__end"))
    before = Window.partitionBy(*names).orderBy("__s").rowsBetween(Window.unboundedPreceding, -1)
    inherited = ends.withColumn("__in", F.last("__end", ignorenulls=True).over(before)).select(*names, "__s", "__in")
    within = Window.partitionBy(*names, "__s").orderBy(*([order, sub] if sub else [order])).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    scanned = rows.withColumn("__last", F.last("__v", ignorenulls=True).over(within)).join(inherited, [*names, "__s"], "left")
    return scanned.withColumn("known", F.coalesce("__last", "__in")).select(*df.columns, "known")
