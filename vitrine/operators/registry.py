"""Entities and graph of a collection: mentions, resolved ids, masters, aliases, sources, triples, dimensions, nodes.

Everything follows from one long table of mentions in the order of records and, inside a record, of registration.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.functions import materials as material_texts
from vitrine.functions import periods
from vitrine.functions.text import artist_key, artist_segments, entity_uri, let, lookup_name, norm_key, slug, split_artists, split_cultures, strip
from vitrine.operators.changes import last_known
from vitrine.runtime import cut
from vitrine.schema import COLUMNS

#: Entity type, predicate.
RELATIONS = {"museum": "belongsToMuseum", "location": "locatedIn", "dynasty": "belongsToDynasty", "type": "hasType", "material": "usesMaterial", "primary": "hasPrimaryMaterial", "culture": "hasCulture", "artist": "createdBy"}
#: Columns that become properties, by their camel-case names.
PROPERTIES = "title period period_start_year period_end_year description provenance bibliography dimensions detail_url image_url image_urls iiif_manifest_url image_path image_paths image_count credit_line accession_number source_updated_at crawl_date artist_province artist_wikidata_id artist_birth artist_death artist_bio artist_wikipedia_summary artist_enriched_at".split()


def camel(name: str) -> str:
    head, *rest = name.split("_")
    return head + "".join(w.capitalize() for w in rest)


def _prepare(df: DataFrame) -> DataFrame:
    """Text columns and the artifact's id; rows without ids dropped."""
    have = set(df.columns)
    rows = df.select(F.col("seq") if "seq" in have else F.monotonically_increasing_id().alias("seq"), *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in have else F.lit("").alias(c) for c in COLUMNS])
    rows = rows.withColumns({"museum_id": F.trim("museum_id"), "object_id": F.trim("object_id")}).where("museum_id <> '' AND object_id <> ''")
    return rows.withColumn("artifact_id", F.concat_ws(":", F.lit("entity:artifact"), "museum_id", "object_id"))


def mentions(df: DataFrame, roles: tuple[str, ...] = tuple(RELATIONS)) -> DataFrame:
    """(seq, sub, artifact_id, museum_id, object_id, role, entity_type, label, norm, ext_id, field_name) of every entity
    a record names, in order. The maker's external id counts for the maker the field would be looked up by, or the only one. Only the
    roles asked for are read; what others would cost isn't paid."""
    rows = _prepare(df)
    item = lambda role, kind, label, norm=None, field=None: F.struct(F.lit(role).alias("role"), F.lit(kind).alias("entity_type"), label.alias("label"), (norm if norm is not None else norm_key(label)).alias("norm"), F.lit(field or role).alias("field_name"))
    some = lambda role, kind, label, **k: F.array_compact(F.array(let(label, lambda v: F.when(v != "", item(role, kind, v, **k)))))
    era = F.when(strip("dynasty") != "", strip("dynasty")).otherwise(periods.era("period", F.expr("try_cast(trim(period_start_year) AS int)"), F.expr("try_cast(trim(period_end_year) AS int)")))
    museum = F.when(strip("museum") != "", strip("museum")).otherwise(F.concat(F.lit("Museum-"), "museum_id"))
    readers = {
        "museum": lambda: F.array(item("museum", "Museum", museum, norm=F.col("museum_id"))),
        "location": lambda: some("location", "Location", strip("location")),
        "dynasty": lambda: some("dynasty", "Dynasty", era),
        "type": lambda: some("type", "ArtifactType", strip("type")),
        "material": lambda: F.transform("materials", lambda m: item("material", "Material", m, field="material")),
        "primary": lambda: some("primary", "Material", material_texts.primary(F.col("materials")), field="material"),
        "culture": lambda: F.transform(split_cultures("culture"), lambda v: item("culture", "Culture", v)),
        "artist": lambda: F.transform(split_artists("artist"), lambda v: item("artist", "Artist", v)),
    }
    if {"material", "primary"} & set(roles):
        rows = rows.withColumn("materials", material_texts.materials("material"))
    every = F.concat(*[read() for role, read in readers.items() if role in roles])
    chosen = rows.withColumns({"__lookup": artist_key(lookup_name("artist")), "__alone": F.size(artist_segments("artist")) == 1})
    long = chosen.select("seq", "artifact_id", "museum_id", "object_id", F.trim("artist_wikidata_id").alias("__q"), "__lookup", "__alone", F.posexplode(every).alias("sub", "m")).select("*", "m.*").drop("m")
    own = F.when((F.col("entity_type") == "Artist") & F.col("__q").startswith("Q") & (F.col("__lookup") != "") & ((artist_key("label") == F.col("__lookup")) | F.col("__alone")), F.col("__q")).otherwise("")
    return long.withColumn("ext_id", own).where("norm <> '' OR ext_id <> ''").drop("__q", "__lookup", "__alone")


def resolve(m: DataFrame) -> DataFrame:
    """mentions with canonical_id: a maker's own external id, else the last one its key had before, else a slug; every
    other entity a pure function of its key."""
    # only makers have external ids, so no other entity needs a scan; the records are read once for all three passes
    m = cut(m)
    makers = last_known(m.where("entity_type = 'Artist'"), "norm", "ext_id", "seq", "sub")
    makers = makers.withColumn("canonical_id", F.concat(F.lit("entity:artist:"), F.coalesce("known", slug("label")))).drop("known")
    name = F.when(F.col("entity_type") == "Museum", F.col("norm")).when(F.col("entity_type") == "Location", slug("label")).otherwise(slug("norm"))
    rest = m.where("entity_type <> 'Artist'").withColumn("canonical_id", F.concat(F.lit("entity:"), F.lower("entity_type"), F.lit(":"), name))
    return makers.unionByName(rest)


def masters(r: DataFrame, base: str = "https://data.example") -> DataFrame:
    """One row per entity: first label and key, first external id, how often it was met, its address."""
    at = F.struct("seq", "sub")
    out = r.groupBy("canonical_id").agg(F.min_by("entity_type", at).alias("entity_type"), F.min_by("label", at).alias("label"), F.min_by("norm", at).alias("norm_label"), F.coalesce(F.min_by(F.when(F.col("ext_id") != "", F.col("ext_id")), F.when(F.col("ext_id") != "", at)), F.lit("")).alias("external_id"), F.count("*").alias("source_count"))
    return out.withColumn("uri", entity_uri(base, "canonical_id"))


def aliases(r: DataFrame) -> DataFrame:
    """First spelling of each key of an entity, how it was matched and how sure that is."""
    out = r.groupBy("canonical_id", "norm").agg(F.min_by(F.struct("label", "entity_type", "ext_id"), F.struct("seq", "sub")).alias("f")).select("canonical_id", F.col("f.label").alias("alias"), F.col("norm").alias("norm_alias"), "f.entity_type", "f.ext_id")
    artist = F.col("entity_type") == "Artist"
    known = F.col("ext_id") != ""
    return out.withColumn("match_method", F.when(artist & known, "external_id").otherwise("norm_label")).withColumn("confidence", F.when(artist, F.when(known, 0.95).otherwise(0.8)).otherwise(1.0)).drop("entity_type", "ext_id")


def sources(r: DataFrame) -> DataFrame:
    return r.select("canonical_id", "museum_id", "object_id", "field_name", F.col("label").alias("raw_value"))


def relations(r: DataFrame) -> DataFrame:
    """Distinct triples from artifacts to entities."""
    pairs = F.create_map(*[F.lit(x) for kv in RELATIONS.items() for x in kv])
    return r.select(F.col("artifact_id").alias("from"), pairs[F.col("role")].alias("relation"), F.col("canonical_id").alias("to")).distinct()


def properties(df: DataFrame) -> DataFrame:
    """Distinct triples from artifacts to texts: every non-blank property column, and the material as text, list and main one."""
    rows = _prepare(df).withColumn("materials", material_texts.materials("material"))
    extra = {"materialSummary": strip("material"), "materialBase": F.array_join("materials", " | "), "materialPrimary": material_texts.primary(F.col("materials"))}
    every = F.array(*[F.struct(F.lit(camel(c)).alias("relation"), strip(c).alias("to")) for c in PROPERTIES], *[F.struct(F.lit(n).alias("relation"), v.alias("to")) for n, v in extra.items()])
    return rows.select(F.col("artifact_id").alias("from"), F.explode(every).alias("p")).select("from", "p.*").where(F.col("to") != "").distinct()


def dimension(m: DataFrame, entity_type: str) -> DataFrame:
    return m.where(F.col("entity_type") == entity_type).select(F.col("canonical_id").alias("id"), F.col("label").alias("name")).orderBy("id")


def label_of(x: Column | str) -> Column:
    """Node label of an id, by the second part of its name."""
    part = F.split_part(F.col(x) if isinstance(x, str) else x, F.lit(":"), F.lit(2))
    names = {"artist": "Artist", "museum": "Museum", "location": "Location", "dynasty": "Dynasty", "artifacttype": "ArtifactType", "material": "Material", "culture": "Culture", "artifact": "Artifact"}
    return F.coalesce(F.create_map(*[F.lit(v) for kv in names.items() for v in kv])[part], F.lit("Entity"))


def merge_nodes(nodes: DataFrame, new: DataFrame, keep: bool) -> DataFrame:
    """nodes(id, name) with new ones put in: a name that is there stays (keep) or is overwritten."""
    one = new.groupBy("id").agg(F.max("name").alias("__n"))
    return nodes.join(one, "id", "full_outer").select("id", (F.coalesce("name", "__n") if keep else F.coalesce("__n", "name")).alias("name"))


def implied_nodes(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Ends of edges that are no nodes yet."""
    ends = edges.select(F.explode(F.array("from", "to")).alias("id")).distinct()
    return ends.join(nodes.select("id"), "id", "left_anti").withColumn("label", label_of("id"))


def graph_counts(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes by label; no row at all while there are no relationships, as the two-step match of the graph gives."""
    any_edge = edges.limit(1).select(F.lit(1).alias("__e"))
    return nodes.groupBy(label_of("id").alias("label")).agg(F.count("*").alias("n")).join(F.broadcast(any_edge)).drop("__e")


def with_properties(nodes: DataFrame, props: DataFrame, names: list[str], most: int = 8000) -> DataFrame:
    """Artifact nodes with their properties as columns, cut to ``most`` characters; triples of unknown nodes are dropped."""
    known = props.where(F.col("relation").isin(names)).join(nodes.select(F.col("id").alias("from")), "from", "left_semi")
    wide = known.groupBy("from").pivot("relation", names).agg(F.substring(F.max("to"), 1, most))
    return nodes.join(wide.withColumnRenamed("from", "id"), "id", "left")
