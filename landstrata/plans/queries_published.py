"""Registered queries over what a build writes: files, documents, digests and their checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from landstrata.functions import boxes, fixed
from landstrata.operators import aggregates, checks, covering, pruning
from landstrata.plans import build
from landstrata.plans.check_sql import compose, curve, cut, extent, mean_cost, search_attempts, verdict
from landstrata.plans.features import features, shaped_features, table
from landstrata.plans.flagship import write_simple
from landstrata.plans.queries_columns import CORRUPT_SQL, _values, corrupt_codes
from landstrata.plans.registry import GEOMETRY, GROUP_BYTES, KEY, ONLY, flat, published, published_levels, query, units_layer
from landstrata.session import materialise
from landstrata.sources import catalog, documents, footers, inventory, layers

UNIT = covering.COST_UNIT
AREA = (-100.0, 30.0, -85.0, 40.0)
W, S, E, N = AREA
CLOSED = f"xmax >= {W!r} AND xmin <= {E!r} AND ymax >= {S!r} AND ymin <= {N!r}"
SIDES = "xmin, ymin, xmax, ymax"
CLAMPED = "greatest(-18e1, w) AS xmin, greatest(-9e1, s) AS ymin, least(18e1, e) AS xmax, least(9e1, n) AS ymax"

# The layout the published data has: the whole search, over the features.
LAID = [
    curve("features"), mean_cost("features", UNIT), search_attempts(GROUP_BYTES, 0.5, UNIT),
    cut(f"CASE WHEN xmin IS NULL THEN 0 ELSE 93 END * {UNIT} + (SELECT attribute_cost FROM attribute_cost c WHERE c.part_key = p.part_key)", 100_000),
    verdict(),
]
KEPT = "grouped g JOIN chosen c ON c.part_key = g.part_key AND c.attempt = g.attempt"
FILE = "'part_key=' || {0} || '/data.parquet'"


def units(spark, sf_dir) -> str:
    root, _ = published(spark, sf_dir)
    return f"{root}/units-1/units"


# ---- sources -----------------------------------------------------------------------------------


@query("scan_partition", compose("SELECT fid, huc12, area_km2 FROM features WHERE part_key = '07'"))
def scan_partition(spark, sf_dir):
    return layers.scan_partition(spark, units(spark, sf_dir), KEY, "07", ["fid", "huc12", "area_km2"])


@query("scan_all", compose(f"SELECT fid, part_key, huc12, gap_sts, area_km2, tohuc, {SIDES} FROM features"))
def scan_all(spark, sf_dir):
    rows = layers.scan_all(spark, units(spark, sf_dir))
    return flat(rows, "fid", KEY, "huc12", "gap_sts", "area_km2", "tohuc")


@query(
    "scan_layer",
    compose("SELECT part_key, huc12, gap_sts, area_km2, tohuc, CAST(CASE WHEN xmin IS NOT NULL THEN 93 END AS INTEGER) AS geometry FROM features"),
)
def scan_layer(spark, sf_dir):
    landed = shaped_features(spark, sf_dir).withColumnsRenamed({"fid": "objectid", GEOMETRY: "shape"})
    layer = layers.scan_layer(landed, ("objectid",), {"shape": "geometry"})
    return layer.withColumn("geometry", F.octet_length("geometry"))


@query("scan_items", compose(f"SELECT 'units' AS collection, 'part_key=' || part_key AS id, part_key AS value, row_count AS rows, {CLAMPED} FROM extent", extent("features")))
def scan_items(spark, sf_dir):
    root, _ = published(spark, sf_dir)
    return catalog.scan_items(spark, f"{root}/units-1").select("collection", "id", "value", "rows", *boxes.SIDES)


@query("scan_versions", compose(f"SELECT DISTINCT 'units' AS collection, '1.0.0' AS version, {FILE.format('part_key')} AS path, {FILE.format('part_key')} AS href FROM features"))
def scan_versions(spark, sf_dir):
    root, _ = published(spark, sf_dir)
    return catalog.scan_versions(spark, f"{root}/units-1").select("collection", "version", "path", "href")


@query(
    "scan_manifests",
    compose(
        """SELECT 'units-1' AS dataset, path, true AS sized, CAST(64 AS INTEGER) AS digits FROM (
             SELECT DISTINCT 'units/part_key=' || part_key || '/data.parquet' AS path FROM features
             UNION ALL SELECT DISTINCT 'units/part_key=' || part_key || '/part_key=' || part_key || '.json' FROM features
             UNION ALL SELECT * FROM (VALUES ('catalog.json'), ('units/collection.json'), ('units/versions.json')) v(path)) q"""
    ),
)
def scan_manifests(spark, sf_dir):
    root, _ = published(spark, sf_dir)
    listed = catalog.scan_manifests(spark, root)
    return listed.select("dataset", "path", (F.col("bytes") > 0).alias("sized"), F.length("sha256").alias("digits"))


@query("scan_catalogs", compose("SELECT 'units-1' AS name, 'units-1' AS id, 'Units, first edition' AS title, count(*) AS items FROM extent", extent("features")))
def scan_catalogs(spark, sf_dir):
    """Child catalogs, with the items found below each."""
    root, _ = published(spark, sf_dir)
    items = catalog.scan_items(spark, f"{root}/units-1").agg(F.count(F.lit(1)).alias("items"))
    return catalog.scan_catalogs(spark, root).withColumn("items", items.scalar())


@query(
    "file_inventory",
    compose(
        """SELECT path, true AS agrees FROM (SELECT DISTINCT 'part_key=' || part_key || '/data.parquet' AS path FROM features
           UNION ALL SELECT DISTINCT 'part_key=' || part_key || '/part_key=' || part_key || '.json' FROM features
           UNION ALL SELECT 'collection.json') q"""
    ),
)
def file_inventory(spark, sf_dir):
    """Files of a collection but its versions document; sizes and digests against the manifest's."""
    root, _ = published(spark, sf_dir)
    found = inventory.file_inventory(spark, f"{root}/units-1/units", exclude=("versions.json",))
    stated = catalog.scan_manifests(spark, root).select(
        F.expr("substring(path, 7)").alias("path"), F.col("bytes").alias("stated_bytes"), F.col("sha256").alias("stated_sha256")
    )
    same = (F.col("bytes") == F.col("stated_bytes")) & (F.col("sha256") == F.col("stated_sha256"))
    return found.join(stated, "path", "left").select("path", F.coalesce(same, F.lit(False)).alias("agrees"))


# ---- reading through the key, the code and the box ---------------------------------------------


@query("partition_eq", compose("SELECT part_key, count(*) AS units, min(huc12) AS first_code FROM features WHERE part_key = '16' GROUP BY part_key"))
def partition_eq(spark, sf_dir):
    rows = layers.scan_all(spark, units(spark, sf_dir)).where(F.col(KEY) == "16")
    return rows.groupBy(KEY).agg(F.count(F.lit(1)).alias("units"), F.min("huc12").alias("first_code"))


@query("code_prefix_lookup", compose(f"SELECT fid, part_key, huc12, {SIDES} FROM features WHERE huc12 = (SELECT max(huc12) FROM features)"))
def code_prefix_lookup(spark, sf_dir):
    rows = layers.scan_all(spark, units(spark, sf_dir))
    last = features(spark, sf_dir).agg(F.max("huc12").alias("code")).scalar()
    return flat(layers.code_lookup(rows, KEY, "huc12", last), "fid", KEY, "huc12")


@query("only", compose("SELECT fid, part_key FROM features WHERE part_key IN ('03', '07', '16')"))
def only(spark, sf_dir):
    rows = layers.scan_all(spark, units(spark, sf_dir))
    return layers.only(rows, KEY, ["03", "07", "16"]).select("fid", KEY)


@query("item_pruning", compose(f"SELECT fid, part_key, {SIDES} FROM features WHERE {CLOSED}"))
def item_pruning(spark, sf_dir):
    root, _ = published(spark, sf_dir)
    items = catalog.scan_items(spark, f"{root}/units-1")
    return flat(pruning.item_pruned(layers.scan_all(spark, units(spark, sf_dir)), items, KEY, AREA), "fid", KEY)


@query("not_null_key_guard", compose(f"SELECT count(*) FILTER (WHERE code IS NULL) AS null_keys FROM (SELECT {CORRUPT_SQL} AS code FROM features) q"))
def not_null_key_guard(spark, sf_dir):
    return checks.null_keys(corrupt_codes(spark, sf_dir), "code")


@query("units_in_box", compose(f"SELECT fid, huc12, gap_sts FROM features WHERE part_key = '07' AND {CLOSED}"))
def units_in_box(spark, sf_dir):
    return layers.units_in_box(spark, units(spark, sf_dir), KEY, "07", AREA, ["fid", "huc12", "gap_sts"])


# ---- facts about what was written --------------------------------------------------------------

FACTS_SQL = compose(
    """SELECT part_key AS value, row_count AS rows, empties AS empty_geometries, 'Polygon' AS geometry_types, w AS xmin, s AS ymin, e AS xmax, n AS ymax,
       row_groups, large_rows, order_ok, CAST(budget // {} AS BIGINT) AS group_bytes, fraction AS large_fraction
       FROM extent JOIN chosen c USING (part_key) JOIN attempts a USING (attempt)
       JOIN (SELECT part_key, attempt, count(DISTINCT group_id) AS row_groups, count(*) FILTER (WHERE is_large) AS large_rows
             FROM laid GROUP BY part_key, attempt) l USING (part_key, attempt)""".format(UNIT),
    *LAID,
)


@query("partition_facts", FACTS_SQL)
def partition_facts(spark, sf_dir):
    _, done = published(spark, sf_dir)
    return done.facts.select(
        "value", "rows", "empty_geometries", F.concat_ws(",", "geometry_types").alias("geometry_types"), *boxes.SIDES,
        "row_groups", "large_rows", "order_ok", "group_bytes", "large_fraction",
    )


@query(
    "manifest_partition_summary",
    compose(
        """SELECT 'units' AS collection, part_key AS value, row_count AS rows, row_groups, true AS sized
           FROM extent JOIN (SELECT g.part_key, count(*) AS row_groups FROM {} GROUP BY g.part_key) q USING (part_key)""".format(KEPT),
        *LAID,
    ),
)
def manifest_partition_summary(spark, sf_dir):
    _, done = published(spark, sf_dir)
    summary = documents.partition_summary(done.facts)
    sized = (F.col("max_row_group_uncompressed") > 0) & (F.col("bytes") > 0) & (F.length("sha256") == 64)
    return summary.select("collection", "value", "rows", "row_groups", sized.alias("sized"))


@query("manifest_totals", compose("SELECT count(*) AS parquet_files, true AS sized FROM extent", extent("features")))
def manifest_totals(spark, sf_dir):
    root, _ = published(spark, sf_dir)
    totals = documents.manifest_totals(catalog.scan_manifests(spark, root))
    return totals.select("parquet_files", (F.col("parquet_bytes") > 0).alias("sized"))


GROUPS_SQL = compose(
    f"""SELECT {FILE.format('g.part_key')} AS path, CAST(group_id AS INTEGER) AS group_no, row_count AS rows, xmin, ymin, xmax, ymax,
        xmin IS NOT NULL AS has_min_max FROM {KEPT}""",
    *LAID,
)


@query("write_clustered", GROUPS_SQL)
def write_clustered(spark, sf_dir):
    """Row groups as the footers of the written files have them."""
    groups = footers.scan_footers(spark, units(spark, sf_dir))
    return groups.select("path", "group_no", "rows", *boxes.SIDES, "has_min_max")


@query(
    "probe_footers",
    compose(
        f"""SELECT {FILE.format('g.part_key')} AS path, count(*) AS row_groups, CAST(sum(row_count) AS BIGINT) AS rows,
            coalesce(string_agg(CAST(group_id AS VARCHAR), ',' ORDER BY group_id) FILTER (WHERE {CLOSED}), '') AS selected,
            count(*) FILTER (WHERE {CLOSED}) AS selected_groups,
            CAST(coalesce(sum(row_count) FILTER (WHERE {CLOSED}), 0) AS BIGINT) AS selected_rows, true AS sized FROM {KEPT} GROUP BY g.part_key""",
        *LAID,
    ),
)
def probe_footers(spark, sf_dir):
    """The pruning report of the written files, from their footers only."""
    report = pruning.probe(footers.scan_footers(spark, units(spark, sf_dir)), AREA)
    sized = (F.col("selected_compressed_bytes") <= F.col("column_chunk_bytes")) & (F.col("column_chunk_bytes") < F.col("file_bytes"))
    selected = F.concat_ws(",", F.col("selected_row_groups").cast("array<string>")).alias("selected")
    return report.select("path", "row_groups", "rows", selected, "selected_groups", "selected_rows", sized.alias("sized"))


@query("write_clustered_simple", compose(f"SELECT fid, part_key, huc12, {SIDES} FROM features"))
def write_clustered_simple(spark, sf_dir):
    return flat(layers.scan_all(spark, write_simple(spark, sf_dir), committed=False), "fid", KEY, "huc12")


@query("immutable_output", compose("SELECT count(*) AS rows, true AS refused FROM features"))
def immutable_output(spark, sf_dir):
    """Building over an existing dataset is refused and leaves it as it was."""
    root, _ = published(spark, sf_dir)
    try:
        build.build_dataset(spark, "units", [units_layer(shaped_features(spark, sf_dir))], f"{root}/units-1", "x", "x", "x")
        refused = False
    except FileExistsError:
        refused = True
    return aggregates.layer_count(layers.scan_all(spark, units(spark, sf_dir))).withColumn("refused", F.lit(refused))


LABEL_SQL = f"""SELECT part_key, trim('Region ' || part_key || ' ' || coalesce(name, '')) AS label
  FROM (SELECT DISTINCT part_key FROM features) f LEFT JOIN {_values(fixed.REGION_NAMES)} ON code = part_key"""


@query("write_items", compose(f"SELECT 'units' AS collection, part_key AS value, 'Units: ' || label AS title, CAST(8 AS INTEGER) AS columns FROM ({LABEL_SQL}) q"))
def write_items(spark, sf_dir):
    root, _ = published(spark, sf_dir)
    items = catalog.scan_items(spark, f"{root}/units-1")
    return items.select("collection", "value", "title", F.json_array_length("columns").alias("columns"))


@query(
    "write_collections",
    compose(
        """SELECT 'units' AS collection, 'Units' AS title, CAST(sum(row_count) AS BIGINT) AS rows, count(*) AS files, greatest(-18e1, min(w)) AS xmin,
           greatest(-9e1, min(s)) AS ymin, least(18e1, max(e)) AS xmax, least(9e1, max(n)) AS ymax FROM extent""",
        extent("features"),
    ),
)
def write_collections(spark, sf_dir):
    root, _ = published(spark, sf_dir)
    return catalog.scan_collections(spark, f"{root}/units-1").drop("columns")


@query(
    "write_versions",
    compose(
        f"""SELECT part_key, {FILE.format('part_key')} AS change, CAST(row_number() OVER (ORDER BY part_key) - 1 AS INTEGER) AS place
            FROM (SELECT DISTINCT part_key FROM features) q"""
    ),
)
def write_versions(spark, sf_dir):
    """The sorted list of changed paths in the versions document."""
    root, _ = published(spark, sf_dir)
    raw = spark.read.option("multiLine", "true").schema(catalog.VERSIONS_TYPE).json(f"{root}/units-1/units/versions.json")
    listed = raw.select(F.posexplode(F.expr("versions[0].changes")).alias("place", "change"))
    return listed.select(F.substring("change", 10, 2).alias("part_key"), "change", "place")


@query("write_manifest", compose("SELECT 'units' AS kind, 2 * count(*) + 3 AS files, count(*) AS parquet_files, count(*) AS partitions FROM extent", extent("features")))
def write_manifest(spark, sf_dir):
    root, _ = published(spark, sf_dir)
    raw = spark.read.option("multiLine", "true").schema(catalog.MANIFEST_TYPE).json(f"{root}/units-1/manifest.json")
    return raw.select(
        "kind", F.size("files").cast("bigint").alias("files"), "totals.parquet_files",
        F.size(F.element_at("collections", F.lit("units"))).cast("bigint").alias("partitions"),
    )


@query("write_root", compose("SELECT 'child' AS rel, './units-1/catalog.json' AS href, 'Units, first edition' AS title, count(*) AS rows FROM features"))
def write_root(spark, sf_dir):
    """The root catalog's children, with the rows published below them."""
    root, _ = published(spark, sf_dir)
    raw = spark.read.option("multiLine", "true").schema(catalog.CATALOG_TYPE).json(f"{root}/catalog.json")
    links = raw.select(F.explode("links").alias("l")).select("l.rel", "l.href", "l.title").where("rel = 'child'")
    rows = catalog.scan_items(spark, f"{root}/units-1").agg(F.sum("rows").alias("rows"))
    return links.withColumn("rows", rows.scalar())


# ---- two levels of units, some regions ---------------------------------------------------------

LEVEL_ROWS = f"""SELECT 'hu12' AS collection, part_key AS value, count(*) AS rows FROM features WHERE part_key IN {tuple(ONLY)} GROUP BY part_key
  UNION ALL SELECT 'hu14', part_key, count(*) FROM features WHERE part_key IN {tuple(ONLY)} AND part_key < '10' GROUP BY part_key"""
# The columns of the levels' files: the key in the path is none of them.
LEVEL_COLUMNS = [
    (level, i, name, kind)
    for level in (12, 14)
    for i, (name, kind) in enumerate(
        [("tnmid", "varchar")]
        + ([("huc12", "varchar"), ("area_km2", "double")] if level == 12 else [("area_km2", "double")])
        + [("geometry", "geometry")]
        + ([("huc14", "varchar")] if level == 14 else [])
        + [("bbox", fixed.BBOX_TYPE)]
    )
]


@query("only_levels", compose(LEVEL_ROWS))
def only_levels(spark, sf_dir):
    """Partitions of a build of two levels for which two regions were wanted."""
    return catalog.scan_items(spark, published_levels(spark, sf_dir)).select("collection", "value", "rows")


@query(
    "item_columns",
    compose(
        f"""SELECT collection, value, CAST(place AS INTEGER) AS place, name, type FROM ({LEVEL_ROWS}) l
            JOIN (VALUES {", ".join(f"('hu{n}', {i}, '{name}', '{kind}')" for n, i, name, kind in LEVEL_COLUMNS)}) c(level, place, name, type) ON level = collection"""
    ),
)
def item_columns(spark, sf_dir):
    """Names and types of the files' columns as each item lists them."""
    items = catalog.scan_items(spark, published_levels(spark, sf_dir))
    listed = items.select("collection", "value", F.posexplode(F.from_json("columns", "array<struct<name: string, type: string>>")).alias("place", "c"))
    return listed.select("collection", "value", "place", "c.name", "c.type")


@query(
    "manifest_parameters",
    f"""SELECT CAST({GROUP_BYTES} AS BIGINT) AS row_group_bytes, CAST(100000 AS BIGINT) AS max_rows_per_group, CAST(9 AS INTEGER) AS zstd_level,
        CAST(0.5 AS DOUBLE) AS large_feature_fraction_start, '1.1.0, WKB, bbox covering' AS geoparquet, '{",".join(ONLY)}' AS only_values,
        true AS says_order, count(*) AS rows FROM orders JOIN customer ON o_custkey = c_custkey WHERE lpad(CAST(c_nationkey AS VARCHAR), 2, '0') IN {tuple(ONLY)}""",
)
def manifest_parameters(spark, sf_dir):
    """What a build was told, in the types it was told in, and the rows of the coarser level."""
    target = published_levels(spark, sf_dir)
    told = spark.read.option("multiLine", "true").schema(catalog.MANIFEST_TYPE).json(f"{target}/manifest.json").select("parameters.*")
    rows = catalog.scan_items(spark, target).where("collection = 'hu12'").agg(F.sum("rows").alias("rows"))
    return told.select(
        "row_group_bytes", "max_rows_per_group", "zstd_level", "large_feature_fraction_start", "geoparquet", F.col("only").alias("only_values"),
        (F.length("sort") > 0).alias("says_order"),
    ).withColumn("rows", rows.scalar())


# ---- checks ------------------------------------------------------------------------------------


@query("count_reconcile", compose("SELECT count(*) AS partition_rows, count(*) AS source_rows, true AS agrees FROM features"))
def count_reconcile(spark, sf_dir):
    _, done = published(spark, sf_dir)
    return checks.count_reconcile(done.facts, aggregates.layer_count(features(spark, sf_dir)))


@query(
    "readback_check",
    compose(
        """SELECT part_key AS part, row_count AS planned_rows, row_groups AS planned_groups, row_count AS rows, row_groups, true AS agrees
           FROM extent JOIN (SELECT g.part_key, count(*) AS row_groups FROM {} GROUP BY g.part_key) q USING (part_key)""".format(KEPT),
        *LAID,
    ),
)
def readback_check(spark, sf_dir):
    _, done = published(spark, sf_dir)
    found = footers.scan_footers(spark, units(spark, sf_dir)).withColumn("part", F.substring("path", 10, 2))
    return checks.readback_check(found, done.facts.withColumnRenamed("value", "part"))


@query("stats_present", compose(f"SELECT g.part_key, count(*) AS row_groups, count(*) FILTER (WHERE xmin IS NULL) AS without FROM {KEPT} GROUP BY g.part_key", *LAID))
def stats_present(spark, sf_dir):
    groups = footers.scan_footers(spark, units(spark, sf_dir)).withColumn("part_key", F.substring("path", 10, 2))
    missing = checks.stats_missing(groups).groupBy("part_key").agg(F.count(F.lit(1)).alias("without"))
    counted = groups.groupBy("part_key").agg(F.count(F.lit(1)).alias("row_groups")).join(missing, "part_key", "left")
    return counted.select("part_key", "row_groups", F.coalesce("without", F.lit(0).cast("bigint")).alias("without"))


@query(
    "empty_partition",
    compose("SELECT DISTINCT lpad(CAST(s_nationkey * 2 AS VARCHAR), 2, '0') AS part_key FROM supplier WHERE lpad(CAST(s_nationkey * 2 AS VARCHAR), 2, '0') NOT IN (SELECT part_key FROM features)"),
)
def empty_partition(spark, sf_dir):
    """Wanted partitions (every second number, from the suppliers) that have no features."""
    wanted = table(spark, sf_dir, "supplier").select(F.lpad((F.col("s_nationkey") * 2).cast("string"), 2, "0").alias(KEY))
    return checks.empty_partitions(wanted, aggregates.partition_extent(features(spark, sf_dir), KEY), KEY)


TREES_SQL = """trees AS MATERIALIZED (
  SELECT lang || '/' || CAST(doc_id // 100 AS VARCHAR) AS tree, count(*) AS files, CAST(sum(octet_length(encode(text))) AS BIGINT) AS bytes,
         sha256(string_agg(path || chr(9) || sha256(text) || chr(10), '' ORDER BY string_split(path, '/'))) AS sha256
  FROM (SELECT *, source || '/' || CAST(doc_id AS VARCHAR) AS path FROM documents) q GROUP BY 1)"""


def document_files(spark, sf_dir):
    """Documents as files of trees: a tree per language and hundred documents."""
    return table(spark, sf_dir, "documents").select(
        F.concat("lang", F.lit("/"), F.expr("doc_id div 100").cast("string")).alias("tree"),
        F.concat("source", F.lit("/"), F.col("doc_id").cast("string")).alias("path"),
        F.octet_length("text").cast("bigint").alias("bytes"),
        F.sha2("text", 256).alias("sha256"),
    )


@query("tree_digest", f"WITH {TREES_SQL} SELECT * FROM trees")
def tree_digest(spark, sf_dir):
    return inventory.tree_digest(document_files(spark, sf_dir), "tree")


@query(
    "source_pin",
    f"WITH {TREES_SQL} SELECT tree, bytes % 2 = 0 AS matches, bytes % 2 = 0 AS accepted, files, files + bytes % 2 AS pinned_files FROM trees",
)
def source_pin(spark, sf_dir):
    """Digests of trees against pins of which some (those of odd size) count a file too many."""
    found = materialise(inventory.tree_digest(document_files(spark, sf_dir), "tree"))
    pins = found.withColumn("files", F.col("files") + F.col("bytes") % 2)
    return checks.source_pin(found, pins, "tree").select("tree", "matches", "accepted", "files", "pinned_files")


# What is live: the labelled documents, their sizes in characters, their texts trimmed.
LIVE_SQL = "SELECT d.doc_id, d.lang, d.source, n_chars AS live_bytes, sha256(trim(text)) AS live_sha256 FROM documents d JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id)"


def live_documents(spark, sf_dir):
    labelled = table(spark, sf_dir, "labels").select("doc_id").distinct()
    return table(spark, sf_dir, "documents").join(labelled, "doc_id", "left_semi").select(
        "doc_id", "lang", "source", F.col("n_chars").alias("bytes"), F.sha2(F.trim("text"), 256).alias("sha256")
    )


@query(
    "manifest_vs_listing",
    f"""SELECT path, problem FROM (
          SELECT CAST(d.doc_id AS VARCHAR) AS path, CASE WHEN live_bytes IS NULL THEN 'missing'
                 WHEN live_bytes <> octet_length(encode(text)) THEN 'bytes differ'
                 WHEN live_sha256 <> sha256(text) THEN 'sha256 differs' END AS problem
          FROM documents d LEFT JOIN ({LIVE_SQL}) l USING (doc_id)) q WHERE problem IS NOT NULL""",
)
def manifest_vs_listing(spark, sf_dir):
    """Documents as a manifest, against a listing that lacks some and has others changed."""
    manifest = document_files(spark, sf_dir).withColumn("path", F.element_at(F.split("path", "/"), -1))
    live = live_documents(spark, sf_dir).withColumn("path", F.col("doc_id").cast("string"))
    return checks.manifest_vs_listing(manifest, live).select("path", "problem")


@query(
    "tree_diff",
    f"""SELECT path, CASE WHEN l.doc_id IS NULL THEN 'only ours' ELSE 'differ' END AS difference
        FROM (SELECT *, source || '/' || CAST(doc_id AS VARCHAR) || '.' || lang AS path FROM documents WHERE source <> 'src0' AND lang <> 'fr') d
        LEFT JOIN ({LIVE_SQL}) l USING (doc_id)
        WHERE l.doc_id IS NULL OR live_bytes <> octet_length(encode(text)) OR live_sha256 <> sha256(text)""",
)
def tree_diff(spark, sf_dir):
    """Two trees of documents that should be equal, but for one folder and one suffix."""
    path = F.concat("source", F.lit("/"), F.col("doc_id").cast("string"), F.lit("."), "lang").alias("path")
    ours = table(spark, sf_dir, "documents").select(path, F.octet_length("text").cast("bigint").alias("bytes"), F.sha2("text", 256).alias("sha256"))
    theirs = live_documents(spark, sf_dir).select(path, "bytes", "sha256")
    return checks.tree_diff(ours, theirs, ("src0",), (".fr",))


@query("item_version_agree", compose(f"SELECT DISTINCT 'units' AS collection, {FILE.format('part_key')} AS path, true AS agrees FROM features"))
def item_version_agree(spark, sf_dir):
    root, _ = published(spark, sf_dir)
    items = catalog.scan_items(spark, f"{root}/units-1")
    agree = checks.item_version_agree(catalog.item_assets(items), catalog.scan_versions(spark, f"{root}/units-1"))
    return agree.select("collection", "path", "agrees")


@query("schema_agree", compose("SELECT 'units' AS collection, CAST(1 AS BIGINT) AS schemas, count(*) AS items FROM extent", extent("features")))
def schema_agree(spark, sf_dir):
    root, _ = published(spark, sf_dir)
    items = catalog.scan_items(spark, f"{root}/units-1")
    return checks.schema_agree(items).join(items.groupBy("collection").agg(F.count(F.lit(1)).alias("items")), "collection")
