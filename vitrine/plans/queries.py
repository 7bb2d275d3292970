"""Registered queries of the core: name -> (spark, sf_dir) -> DataFrame, and the SQL to hold them against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine import schema
from vitrine.functions import classify, materials, periods, records, text, urls
from vitrine.operators import changes, dedup, enrich, images, listing, quality, registry
from vitrine.operators.packed import infer_delimiters, split_packed
from vitrine.operators.units import measured
from vitrine.plans import pipelines
from vitrine.runtime import table
from vitrine.streaming import replay

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name, with its SQL if SQL can express it."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


@query()
def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value of every packed field, with its position."""
    return split_packed(table(spark, sf_dir, "artifact"))


@query()
def p4_delimiters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What notation each source uses in each field, and how sure that is."""
    return infer_delimiters(table(spark, sf_dir, "artifact"))


@query()
def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every measured quantity in whole millimetres or grams."""
    return measured(table(spark, sf_dir, "artifact"))


@query()
def p6_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantities, texts and mean size by museum and unit."""
    a = table(spark, sf_dir, "artifact").select("seq", "museum_id", "dimensions")
    m = measured(a.withColumn("seq", F.struct("seq", "museum_id"))).select("seq.*", "pos", "unit", "amount")
    return m.groupBy("museum_id", "unit").agg(F.count("*").alias("quantities"), F.sum((F.col("pos") == 1).cast("long")).alias("texts"), F.avg("amount").alias("mean_amount"))


# ---- the reference's own operators on the artifact tables, with the SQL that says the same -------------------------


def artifact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "artifact")


#: SQL for the functions of functions.text.
S_STRIP = r"regexp_replace(regexp_replace(coalesce({0},''), '^[\s\x{{00a0}}\x{{3000}}]+', ''), '[\s\x{{00a0}}\x{{3000}}]+$', '')"
S_NORM = r"regexp_replace(lower(regexp_replace(" + S_STRIP + r", '[\s\x{{00a0}}\x{{3000}}]+', ' ', 'g')), '[，,。.;；:：!！?？\"''()（）\[\]{{}}]', '', 'g')"
S_SLUG = r"coalesce(nullif(trim(regexp_replace(" + S_NORM + r", '[^a-z0-9\x{{4e00}}-\x{{9fff}}]+', '-', 'g'), '-'), ''), 'unknown')"
s_strip, s_norm, s_slug = (lambda c, f=f: f.format(c) for f in (S_STRIP, S_NORM, S_SLUG))


@query("""SELECT seq, museum_id, object_id, title, dynasty FROM artifact WHERE museum_id = 2 AND title ILIKE '%bowl%' ORDER BY museum_id, object_id, seq LIMIT 20 OFFSET 20""")
def api_list_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second page of a filtered listing."""
    a = artifact(spark, sf_dir).select("seq", "museum_id", "object_id", "title", "dynasty")
    return listing.page(a, ["museum_id", "object_id", "seq"], 2, 20, {"museum_id": 2}, {"title": "bowl"})


@query("SELECT count(*) AS total FROM artifact WHERE museum_id = 1 AND dynasty ILIKE '%ming%' AND material ILIKE '%silk%'")
def api_list_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing.total(artifact(spark, sf_dir), {"museum_id": 1}, {"dynasty": "ming", "material": "silk", "title": ""})


@query("SELECT seq, museum_id, object_id, title, artist, dimensions FROM artifact WHERE museum_id = 2 AND object_id = '180001'")
def api_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing.detail(artifact(spark, sf_dir).select("seq", "museum_id", "object_id", "title", "artist", "dimensions"), museum_id=2, object_id="180001")


S_FILES = "list_filter(list_transform(string_split(coalesce(nullif(trim(image_paths), ''), image_path, ''), '|'), lambda x: trim(x)), lambda x: x <> '')"


@query(f"""SELECT seq, CASE WHEN len(f) > 0 THEN concat('/api/img/', museum_id, '/', object_id) ELSE '' END AS img_web,
CASE WHEN coalesce(image_count, 0) = 0 THEN len(f) ELSE image_count END AS image_count, len(f) > 0 AS has_local_image, len(f) AS files
FROM (SELECT *, {S_FILES} AS f FROM artifact)""")
def api_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows as the API shows them."""
    return listing.shown(artifact(spark, sf_dir)).select("seq", "img_web", "image_count", "has_local_image", F.size("imgs_web").alias("files"))


@query(f"""SELECT museum_id, object_id, f[2] AS path, CASE WHEN lower(f[2]) LIKE '%.jpg' THEN 'image/jpeg' ELSE 'application/octet-stream' END AS media_type FROM (SELECT *, {S_FILES} AS f FROM artifact) WHERE len(f) > 1""")
def api_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every object's second image."""
    return listing.nth_image(artifact(spark, sf_dir), 1)


@query("SELECT museum_id, count(*) AS n FROM artifact GROUP BY museum_id")
def group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.counts(artifact(spark, sf_dir), "museum_id")


@query("""SELECT museum_id, "column", count(*) AS "rows", count(*) FILTER (coalesce(trim(v), '') = '') AS blank FROM (SELECT museum_id, unnest(['title','detail_url','image_url','crawl_date']) AS "column", unnest([title, detail_url, image_url, crawl_date::varchar]) AS v FROM artifact) GROUP BY ALL""")
def qc_blank_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.blank_counts(artifact(spark, sf_dir), ("title", "detail_url", "image_url", "crawl_date"), ("museum_id",))


@query("SELECT museum_id, count(*) AS total, count(*) FILTER (trim(image_path) <> '') AS with_value FROM artifact GROUP BY museum_id")
def image_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.coverage(artifact(spark, sf_dir))


@query("SELECT museum_id, object_id, count(*) AS n FROM artifact GROUP BY ALL HAVING count(*) > 1")
def repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.repeated(artifact(spark, sf_dir), "museum_id", "object_id")


@query("SELECT coalesce(max(nullif(trim(source_updated_at), '')), '') AS watermark FROM artifact")
def max_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.watermark(artifact(spark, sf_dir))


@query("SELECT seq, source_updated_at FROM artifact WHERE coalesce(trim(source_updated_at), '') = '' OR trim(source_updated_at) > '2022-06-30T00:00:00'")
def incremental_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.since(artifact(spark, sf_dir), "2022-06-30T00:00:00").select("seq", "source_updated_at")


@query(f"""WITH a AS (SELECT seq, museum_id, object_id, {s_strip('detail_url')} AS url, {s_strip('accession_number')} AS acc FROM artifact),
s1 AS (SELECT *, min(seq) OVER (PARTITION BY museum_id, object_id) AS w FROM a),
s2 AS (SELECT *, CASE WHEN url <> '' THEN min(seq) OVER (PARTITION BY museum_id, url) ELSE seq END AS w2 FROM s1 WHERE w = seq),
s3 AS (SELECT *, CASE WHEN acc <> '' THEN min(seq) OVER (PARTITION BY museum_id, acc) ELSE seq END AS w3 FROM s2 WHERE w2 = seq)
SELECT seq, 'duplicate_object_id' AS reason, w AS kept_seq FROM s1 WHERE w <> seq UNION ALL SELECT seq, 'duplicate_detail_url', w2 FROM s2 WHERE w2 <> seq UNION ALL SELECT seq, 'duplicate_accession_number', w3 FROM s3 WHERE w3 <> seq""")
def dedup_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every duplicate with its reason and the row that was kept."""
    return dedup.artifacts(artifact(spark, sf_dir).select("seq", "museum_id", "object_id", "detail_url", "accession_number")).where("reason IS NOT NULL").select("seq", "reason", F.col("kept_by.seq").alias("kept_seq"))


@query("SELECT museum_id, title, min(seq) AS seq, arg_min(object_id, seq) AS object_id FROM artifact GROUP BY museum_id, title")
def first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.first_seen(artifact(spark, sf_dir).select("seq", "museum_id", "title", "object_id"), ["museum_id", "title"])


@query("SELECT image_url, check_id, status_code FROM image_check WHERE image_url IS NOT NULL QUALIFY row_number() OVER (PARTITION BY image_url ORDER BY status_code DESC NULLS LAST, check_id) = 1")
def best_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The check of the highest status of each URL, first of equals."""
    return dedup.best_by_key(table(spark, sf_dir, "image_check").where("image_url IS NOT NULL"), ["image_url"], "status_code", "check_id").select("image_url", "check_id", "status_code")


@query(f"SELECT seq, {s_norm('title')} AS k, {s_slug('title')} AS s, replace(url_encode(replace(concat('entity:type:', {s_slug('title')}), ':', '/')), '%2F', '/') AS path FROM artifact")
def keys_and_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = text.slug("title")
    return artifact(spark, sf_dir).select("seq", text.norm_key("title").alias("k"), s.alias("s"), F.substring(text.entity_uri("b", F.concat(F.lit("entity:type:"), s)), 3, 10000).alias("path"))


@query(r"""SELECT seq, len(p) AS n, array_to_string(p, '#') AS parts FROM (SELECT seq, list_filter(list_transform(regexp_split_to_array(coalesce(artist, ''), '(?i)\s*(?:;|,|、| and |&|/)\s*'), lambda x: trim(x, e' \t\n')), lambda x: x <> '') AS p FROM artifact WHERE artist <> '')""")
def split_artists(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = artifact(spark, sf_dir).where("artist <> ''").select("seq", text.split_artists("artist").alias("p"))
    return a.select("seq", F.size("p").alias("n"), F.array_join("p", "#").alias("parts"))


@query("""SELECT seq, len(p) AS n, array_to_string(p, '#') AS parts FROM (SELECT seq, list_filter(list_transform(CASE WHEN contains(culture, ';') THEN string_split(culture, ';') ELSE string_split(culture, ' / ') END, lambda x: trim(x, e' \\t\\n')), lambda x: len(x) >= 2) AS p FROM (SELECT seq, trim(culture, e' \\t\\n') AS culture FROM artifact WHERE culture <> ''))""")
def split_cultures(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = artifact(spark, sf_dir).where("culture <> ''").select("seq", text.split_cultures("culture").alias("p"))
    return a.select("seq", F.size("p").alias("n"), F.array_join("p", "#").alias("parts"))


S_ISO = r"CASE WHEN regexp_full_match(v, '\d{4}-\d{2}-\d{2}') THEN v WHEN regexp_full_match(v, '\d{4}') THEN concat(v, '-01-01') WHEN regexp_full_match(v, '\d{4}-\d{2}') THEN concat(v, '-01') WHEN regexp_full_match(v, '-\d{1,4}') THEN concat('-', lpad(substr(v, 2, 4), 4, '0'), '-01-01') WHEN len(v) >= 10 AND v[5] = '-' AND v[8] = '-' THEN v[1:10] ELSE v END"


@query(f"SELECT seq, {S_ISO} AS day FROM (SELECT seq, trim(coalesce(artist_birth, '')) AS v FROM artifact UNION ALL SELECT seq, trim(coalesce(source_updated_at, '')) FROM artifact)")
def iso_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = artifact(spark, sf_dir)
    return a.select("seq", periods.iso_date("artist_birth").alias("day")).unionByName(a.select("seq", periods.iso_date("source_updated_at").alias("day")))


S_SNAP = "SELECT trim(object_id) AS object_id, " + ", ".join(f"{s_strip(c)} AS {c}" for c in ("title", "dynasty", "type", "material")) + " FROM artifact WHERE museum_id = 2 AND crawl_date @@ DATE '2024-01-01' QUALIFY row_number() OVER (PARTITION BY object_id ORDER BY seq) = 1"


@query(f"""WITH o AS ({S_SNAP.replace('@@', '<')}), n AS ({S_SNAP.replace('@@', '>=')})
SELECT n.object_id, CASE WHEN o.object_id IS NULL THEN 'new' WHEN n.title <> o.title OR n.dynasty <> o.dynasty OR n.type <> o.type OR n.material <> o.material THEN 'updated' ELSE 'unchanged' END AS change_type,
CASE WHEN o.object_id IS NULL THEN 'title,dynasty,type,material' ELSE array_to_string(list_filter([CASE WHEN n.title <> o.title THEN 'title' END, CASE WHEN n.dynasty <> o.dynasty THEN 'dynasty' END, CASE WHEN n.type <> o.type THEN 'type' END, CASE WHEN n.material <> o.material THEN 'material' END], lambda x: x IS NOT NULL), ',') END AS changed FROM n LEFT JOIN o USING (object_id)""")
def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a later crawl of one museum changes against the earlier one."""
    a = artifact(spark, sf_dir).where("museum_id = 2")
    d = changes.diff(a.where("crawl_date < DATE '2024-01-01'"), a.where("crawl_date >= DATE '2024-01-01'"), "object_id", ["title", "dynasty", "type", "material"], "seq", "seq")
    return d.select("object_id", "change_type", F.array_join("changed_fields", ",").alias("changed"))


@query(f"""SELECT seq, sha256(concat('{{"accession_number":', to_json({s_strip('accession_number')}), ',"object_id":', to_json({s_strip('object_id')}), ',"title":', to_json({s_strip('title')}), '}}')) AS fingerprint FROM artifact""")
def fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return artifact(spark, sf_dir).select("seq", changes.fingerprint(["title", "object_id", "accession_number"]).alias("fingerprint"))


@query("""SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey % 7 <> 0 UNION ALL SELECT c_custkey, c_name, c_acctbal + 1 FROM customer WHERE c_custkey % 7 = 0 UNION ALL SELECT c_custkey + 1000000, c_name, c_acctbal FROM customer WHERE c_custkey % 11 = 0""")
def upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changed rows replace stored ones, new ones are added."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    new = c.where("c_custkey % 7 = 0").withColumn("c_acctbal", F.col("c_acctbal") + 1).unionByName(c.where("c_custkey % 11 = 0").withColumn("c_custkey", F.col("c_custkey") + 1000000))
    return changes.upsert(c, new, ["c_custkey"])


@query("SELECT c_custkey, coalesce(m, c_mktsegment) AS c_mktsegment FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderpriority) AS m FROM orders GROUP BY 1) ON o_custkey = c_custkey")
def backfill_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("c_mktsegment"))
    return changes.backfill(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), o, ["c_custkey"], "c_mktsegment")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def unseen_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.unseen(table(spark, sf_dir, "customer").select("c_custkey"), table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@query("SELECT event_id, last_value(CASE WHEN event_type = 'signup' OR event_id % 5 = 0 THEN event_type END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS known FROM events")
def last_known_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An id met once holds for the later rows of its key, as makers' ids do."""
    e = table(spark, sf_dir, "events").withColumn("v", F.when((F.col("event_type") == "signup") | (F.col("event_id") % 5 == 0), F.col("event_type")))
    return changes.last_known(e, "user_id", "v", "event_id").select("event_id", "known")


S_ID = "concat('entity:artifact:', museum_id, ':', trim(object_id))"
S_TRIPLES = f"""SELECT {S_ID} AS "from", 'belongsToMuseum' AS relation, concat('entity:museum:', museum_id) AS "to" FROM artifact UNION SELECT {S_ID}, 'locatedIn', concat('entity:location:', {s_slug('location')}) FROM artifact WHERE {s_norm('location')} <> '' UNION SELECT {S_ID}, 'hasType', concat('entity:artifacttype:', {s_slug('type')}) FROM artifact WHERE {s_norm('type')} <> ''"""


@query(S_TRIPLES)
def triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct relations of artifacts to museums, places and types."""
    return registry.relations(registry.resolve(registry.mentions(artifact(spark, sf_dir), ("museum", "location", "type"))))


@query(f"SELECT relation, count(*) AS n FROM ({S_TRIPLES}) GROUP BY relation")
def relation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triples(spark, sf_dir).groupBy("relation").agg(F.count("*").alias("n"))


@query()
def entity_masters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every entity of the collection: first label, external id, how often met."""
    return registry.masters(registry.resolve(registry.mentions(artifact(spark, sf_dir))))


@query()
def entity_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.aliases(registry.resolve(registry.mentions(artifact(spark, sf_dir))))


@query("SELECT concat('entity:museum:', museum_id) AS canonical_id, arg_min(CASE WHEN trim(museum) <> '' THEN trim(museum) ELSE concat('Museum-', museum_id) END, seq) AS label, museum_id::varchar AS norm_label, count(*) AS source_count FROM artifact GROUP BY museum_id")
def museum_masters(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = registry.resolve(registry.mentions(artifact(spark, sf_dir), ("museum",)))
    return registry.masters(r).select("canonical_id", "label", "norm_label", "source_count")


@query(f"""SELECT DISTINCT {S_ID} AS "from", r AS relation, v AS "to" FROM (SELECT museum_id, object_id, unnest(['title', 'period', 'dimensions', 'creditLine', 'periodStartYear']) AS r, unnest([{s_strip('title')}, {s_strip('period')}, {s_strip('dimensions')}, {s_strip('credit_line')}, coalesce(period_start_year::varchar, '')]) AS v FROM artifact) WHERE v <> ''""")
def property_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.properties(artifact(spark, sf_dir)).where(F.col("relation").isin("title", "period", "dimensions", "creditLine", "periodStartYear"))


@query(f"""SELECT label, count(*) AS n FROM (SELECT DISTINCT {S_ID} AS id, 'Artifact' AS label FROM artifact UNION SELECT DISTINCT concat('entity:museum:', museum_id), 'Museum' FROM artifact) GROUP BY label""")
def graph_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes by label, of artifacts and museums."""
    t = triples(spark, sf_dir).where("relation = 'belongsToMuseum'")
    nodes = t.select(F.explode(F.array("from", "to")).alias("id")).distinct()
    return registry.graph_counts(nodes, t)


@query("SELECT 'entity:supplier:' || s_suppkey AS id, CASE WHEN s_suppkey % 3 = 0 THEN s_name ELSE s_name || '*' END AS name FROM supplier")
def merge_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known names stay; nodes without one get the new."""
    s = table(spark, sf_dir, "supplier").select(F.concat(F.lit("entity:supplier:"), "s_suppkey").alias("id"), "s_name", "s_suppkey")
    return registry.merge_nodes(s.where("s_suppkey % 3 = 0").select("id", F.col("s_name").alias("name")), s.select("id", F.concat("s_name", F.lit("*")).alias("name")), keep=True)


S_ERAS = ", ".join(f"({i}, '{periods.shown(en, zh)}', {a}, {b}, {periods._rank(en)})" for i, (en, zh, a, b) in enumerate(periods.ERAS))


@query(f"""WITH e(i, v, a, b, k) AS (VALUES {S_ERAS}), p AS (SELECT seq, least(period_start_year, coalesce(period_end_year, period_start_year)) AS s, greatest(period_start_year, coalesce(period_end_year, period_start_year)) AS t FROM artifact WHERE period_start_year IS NOT NULL),
near AS (SELECT seq, v FROM p JOIN e ON a <= t AND b >= s WHERE t - s + 1 <= 80 QUALIFY row_number() OVER (PARTITION BY seq ORDER BY least(t, b) - greatest(s, a) DESC, b - a, i) = 1),
wide AS (SELECT seq, v FROM p JOIN e ON floor((s + t) / 2.0) BETWEEN a AND b WHERE t - s + 1 > 80 QUALIFY row_number() OVER (PARTITION BY seq ORDER BY k, b - a, i) = 1)
SELECT seq, coalesce(n.v, w.v, '') AS era FROM p LEFT JOIN near n USING (seq) LEFT JOIN wide w USING (seq)""")
def era_of_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interval of years to era: longest overlap, or midpoint for long intervals."""
    return artifact(spark, sf_dir).where("period_start_year IS NOT NULL").select("seq", periods.era_of_years("period_start_year", "period_end_year").alias("era"))


def era_sql() -> str:
    by = lambda names, at: sorted(names, key=lambda n: -len(n[at]))
    cases = [(f"contains(l, '{en.lower()}')", en, zh) for en, zh in by([n for n in periods.NAMES if " " in n[0]], 0)] + [(f"regexp_matches(l, '\\b{en.lower()}\\b')", en, zh) for en, zh in by([n for n in periods.NAMES if " " not in n[0]], 0)] + [(f"contains(t, '{zh}')", en, zh) for en, zh in by(periods.NAMES, 1)]
    return "CASE WHEN t = '' THEN '' " + " ".join(f"WHEN {c} THEN '{periods.shown(en, zh)}'" for c, en, zh in cases) + " ELSE '' END"


@query(f"SELECT seq, {era_sql()} AS era FROM (SELECT seq, t, lower(t) AS l FROM (SELECT seq, {s_strip('period')} AS t FROM artifact))")
def era_of_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return artifact(spark, sf_dir).select("seq", periods.era_of_text("period").alias("era"))


@query()
def period_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years read out of every period, and the era they give."""
    return artifact(spark, sf_dir).select("seq", "period", periods.period_years("period").alias("y")).select("seq", "period", "y.start", "y.end")


def _rules_sql(rules: tuple, low: str) -> str:
    return "CASE " + " ".join("WHEN regexp_matches({}, '{}') THEN '{}'".format(low, "|".join(words), label) for label, words in rules)


@query(f"SELECT seq, CASE WHEN t = '' THEN '' ELSE {_rules_sql(classify.TYPES, 'lower(t)')} ELSE CASE WHEN len(t) <= 40 AND NOT contains(t, ';') THEN t ELSE substr(trim(split_part(t, ';', 1)), 1, 80) END END END AS standard FROM (SELECT seq, {s_strip('type')} AS t FROM artifact)")
def standard_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return artifact(spark, sf_dir).select("seq", classify.standard_type("type").alias("standard"))


S_LOW = "lower(coalesce(material, ''))"


@query(f"SELECT seq, {_rules_sql(classify.OF_MATERIAL, S_LOW)} ELSE '' END AS inferred FROM artifact")
def inferred_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return artifact(spark, sf_dir).select("seq", classify.type_of_material("material").alias("inferred"))


@query("SELECT seq, CASE " + " ".join(f"WHEN contains(l, '{p.lower()}') THEN '{p}'" for p in classify.PROVINCES) + r" ELSE trim(regexp_extract(t, '(\w[\w ]+?)\s+[Pp]rovince', 1)) END AS province FROM (SELECT seq, t, lower(t) AS l FROM (SELECT seq, concat_ws(' ', artist_province, culture, provenance) AS t FROM artifact))")
def provinces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return artifact(spark, sf_dir).select("seq", classify.province(F.concat_ws(" ", "artist_province", "culture", "provenance")).alias("province"))


@query(r"""SELECT seq, CASE WHEN regexp_extract(lower(p), '\.(jpg|jpeg|png|tif|tiff|webp|gif)$', 1) = '' THEN 'jpg' ELSE regexp_extract(lower(p), '\.(jpg|jpeg|png|tif|tiff|webp|gif)$', 1) END AS ext, regexp_replace(u, '^http://', 'https://') AS secure,
CASE WHEN q <> '' THEN regexp_replace(q, '(?i)\.(?:jpe?g|png|tiff?|webp)$', '') ELSE lower(split_part(u, '?', 1)) END AS k FROM (SELECT seq, image_url AS u, regexp_extract(image_url, '^https?://[^/?]+([^?#]*)', 1) AS p, regexp_extract(image_url, '[?&]id=([^&#]*)', 1) AS q FROM artifact WHERE image_url IS NOT NULL)""")
def url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = artifact(spark, sf_dir).where("image_url IS NOT NULL")
    return a.select("seq", urls.extension("image_url").alias("ext"), urls.https("image_url").alias("secure"), urls.image_key("image_url").alias("k"))


S_LAST = "SELECT image_url, arg_max(valid, (checked_at, check_id)) AS valid FROM (SELECT image_url, checked_at, check_id, CASE WHEN valid IS NULL THEN -1 WHEN valid THEN 1 ELSE 0 END AS valid FROM image_check WHERE image_url IS NOT NULL) GROUP BY image_url"


@query(f"""SELECT a.seq, CASE WHEN c.valid IS NULL OR c.valid = -1 THEN 'not_checked' WHEN c.valid = 1 THEN 'valid' ELSE 'invalid' END AS state FROM (SELECT seq, trim(image_url) AS image_url FROM artifact WHERE trim(image_url) <> '') a LEFT JOIN ({S_LAST}) c USING (image_url)""")
def image_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State of every record's main image by its last check."""
    s = images.checked(artifact(spark, sf_dir).where("trim(image_url) <> ''"), table(spark, sf_dir, "image_check"))
    return s.where("pos = 0").select("seq", "state")


@query()
def image_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records after bad main images were replaced."""
    return images.repaired(artifact(spark, sf_dir).select("seq", "image_url", "image_urls"), table(spark, sf_dir, "image_check"))


@query()
def maker_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The makers to look up, one per key."""
    return enrich.lookups(artifact(spark, sf_dir))


@query(f"SELECT a.seq, coalesce(v.z, a.type) AS type FROM artifact a LEFT JOIN (SELECT label, max(label_zh) AS z FROM vocab_term GROUP BY label) v ON {s_strip('a.type')} = v.label")
def dict_translate(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = table(spark, sf_dir, "vocab_term").select(F.col("label").alias("source"), F.col("label_zh").alias("target"))
    return enrich.translate(artifact(spark, sf_dir).select("seq", "type"), v, ["type"])


@query(f"SELECT DISTINCT t AS source FROM (SELECT {s_strip('type')} AS t FROM artifact UNION SELECT {s_strip('material')} FROM artifact) WHERE t <> '' AND t NOT IN (SELECT label FROM vocab_term)")
def untranslated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.untranslated(artifact(spark, sf_dir), table(spark, sf_dir, "vocab_term").select(F.col("label").alias("source")), ["type", "material"])


@query()
def material_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Materials, main material and cleaned text of every record."""
    m = materials.with_materials(artifact(spark, sf_dir).select("seq", "material"))
    return m.select("seq", F.array_join("materials", " | ").alias("base"), "primary_material", "material_clean")


@query("SELECT museum_id, try_cast(trim(period_start_year::varchar) AS int) AS period_start_year, crawl_date, concat('entity:artifact:', museum_id, ':', trim(object_id)) AS artifact_id FROM artifact")
def typed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed view of text records."""
    a = artifact(spark, sf_dir).select("seq", *schema.COLUMNS)
    return schema.typed(schema.texts(a), "2026-01-01").select("museum_id", "period_start_year", "crawl_date", "artifact_id")


@query("SELECT event_id, json_extract_string(props, '$.' || k) AS v, k FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events)")
def json_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of JSON texts, one row each, whatever fields a text has."""
    fields = F.explode(F.map_entries(F.from_json("props", "map<string,string>"))).alias("f")
    return table(spark, sf_dir, "events").select("event_id", fields).select("event_id", F.col("f.value").alias("v"), F.col("f.key").alias("k"))


@query()
def object_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records built from an object API's JSON, here the partner's list as JSON."""
    o = table(spark, sf_dir, "object_record")
    j = o.select(F.to_json(F.struct(F.col("rec_id").cast("string").alias("id"), "title", "dated", "period", "classification", "medium", "creditline", "objectnumber", F.array(F.struct(F.col("people").alias("displayname"))).alias("people"), "culture", "lastupdate")).alias("value"))
    return records.from_objects(j, museum_id=4)


@query("SELECT (SELECT count(*) FROM artifact) AS rows_in, (SELECT count(*) FROM artifact) - count(*) AS rows_out, count(*) AS duplicates FROM (" + SQL["dedup_stages"] + ")")
def clean_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standardised, deduplicated records in numbers."""
    return pipelines.clean(artifact(spark, sf_dir))[2]


@query("SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY ALL")
def event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by hour and type, as the stream counts them."""
    w = replay.windowed(table(spark, sf_dir, "events"))
    return w.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("total", 2).alias("total"))
