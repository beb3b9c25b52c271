"""Registered queries over expressions, predicates and plain aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from landstrata.functions import boxes, codes, fixed
from landstrata.operators import aggregates, covering, layout, ordering, readers
from landstrata.plans.check_sql import VARIED, WIDE_TEST, compose, curve, extent, mean_cost
from landstrata.plans.features import features, shaped_features, table
from landstrata.plans.registry import GEOMETRY, KEY, flat, query

AREA = (-100.0, 30.0, -85.0, 40.0)
SIDES = "xmin, ymin, xmax, ymax"
W, S, E, N = AREA

# ---- shapes ------------------------------------------------------------------------------------


def mixed_shapes(spark, sf_dir):
    """Feature rectangles as different kinds of shape, some empty."""
    rows = shaped_features(spark, sf_dir)
    rest = F.expr("substring(geometry, 14)")
    shape = (
        F.when(F.col("fid") % 97 == 5, F.unhex(F.lit("010300000000000000")))
        .when(F.col("fid") % 4 == 1, F.concat(F.unhex(F.lit("010600000001000000")), GEOMETRY))
        .when(F.col("fid") % 4 == 2, F.concat(F.unhex(F.lit("010700000001000000")), GEOMETRY))
        .when(F.col("fid") % 4 == 3, F.concat(F.unhex(F.lit("010200000005000000")), rest))
        .otherwise(F.col(GEOMETRY))
    )
    return rows.withColumn(GEOMETRY, shape)


KIND_SQL = """CASE WHEN fid % 97 = 5 THEN 'Polygon' WHEN xmin IS NULL THEN NULL WHEN fid % 4 = 1 THEN 'MultiPolygon'
  WHEN fid % 4 = 2 THEN 'GeometryCollection' WHEN fid % 4 = 3 THEN 'LineString' ELSE 'Polygon' END"""


@query("with_covering", compose(f"SELECT fid, part_key, {SIDES} FROM features"))
def with_covering(spark, sf_dir):
    return flat(covering.with_covering(shaped_features(spark, sf_dir), GEOMETRY), "fid", "part_key")


@query(
    "geometry_kind",
    compose(
        f"""SELECT fid, {KIND_SQL} AS geometry_kind, CASE WHEN fid % 97 <> 5 THEN xmin END AS xmin,
            CASE WHEN fid % 97 <> 5 THEN ymax END AS ymax FROM features"""
    ),
)
def geometry_kind(spark, sf_dir):
    covered = covering.with_covering(mixed_shapes(spark, sf_dir), GEOMETRY)
    return covered.select("fid", "geometry_kind", "bbox.xmin", "bbox.ymax")


@query("feature_size", compose("SELECT fid, greatest(xmax - xmin, ymax - ymin) AS size FROM features"))
def feature_size(spark, sf_dir):
    return features(spark, sf_dir).select("fid", boxes.larger_side().alias("size"))


@query("wkb_bytes", compose("SELECT fid, CAST(CASE WHEN xmin IS NULL THEN 0 ELSE 93 END AS BIGINT) AS bytes FROM features"))
def wkb_bytes(spark, sf_dir):
    return shaped_features(spark, sf_dir).select("fid", covering.shape_bytes(GEOMETRY).alias("bytes"))


@query("box_centre", compose("SELECT fid, (xmin + xmax) / 2e0 AS x, (ymin + ymax) / 2e0 AS y FROM features"))
def box_centre(spark, sf_dir):
    return features(spark, sf_dir).select("fid", boxes.centre_x().alias("x"), boxes.centre_y().alias("y"))


@query("hilbert_key", compose("SELECT fid, part_key, curve FROM placed", curve("features")))
def hilbert_key(spark, sf_dir):
    rows = features(spark, sf_dir)
    keyed = ordering.with_curve_key(rows, aggregates.partition_extent(rows, KEY), KEY)
    return keyed.select("fid", "part_key", "curve")


CORRUPT_SQL = """CASE WHEN fid % 113 = 0 THEN CASE CAST(fid // 113 AS INT) % 5 WHEN 0 THEN huc12 || chr(10) WHEN 1 THEN NULL
  WHEN 2 THEN 'x' || huc12 WHEN 3 THEN left(huc12, 11) ELSE replace(huc12, '0', 'o') END ELSE huc12 END"""


def corrupt_codes(spark, sf_dir):
    """Unit codes, some with a final newline, a letter, a missing digit, or missing."""
    bad = F.expr(
        """CASE CAST(fid div 113 AS INT) % 5 WHEN 0 THEN concat(huc12, chr(10)) WHEN 1 THEN NULL
           WHEN 2 THEN concat('x', huc12) WHEN 3 THEN left(huc12, 11) ELSE replace(huc12, '0', 'o') END"""
    )
    return features(spark, sf_dir).withColumn("code", F.when(F.col("fid") % 113 == 0, bad).otherwise(F.col("huc12")))


@query("partition_key_from_code", compose("SELECT fid, substr(huc12, 1, 2) AS huc2 FROM features"))
def partition_key_from_code(spark, sf_dir):
    return features(spark, sf_dir).select("fid", codes.region_of("huc12").alias("huc2"))


@query(
    "code_valid",
    compose(
        f"SELECT fid, regexp_full_match(coalesce(code, ''), '[0-9]{{12}}') AS valid FROM (SELECT fid, {CORRUPT_SQL} AS code FROM features) q"
    ),
)
def code_valid(spark, sf_dir):
    return corrupt_codes(spark, sf_dir).select("fid", codes.code_valid("code", 12).alias("valid"))


STRETCHED_SQL = """SELECT fid, xmin * 2 AS xmin, ymin * 2 AS ymin, xmax * 2 AS xmax, ymax * 2 AS ymax FROM features"""


@query(
    "clamp_wgs84",
    compose(
        f"""SELECT fid, CASE WHEN xmin IS NOT NULL THEN greatest(-18e1, xmin) END AS xmin,
            CASE WHEN ymin IS NOT NULL THEN greatest(-9e1, ymin) END AS ymin,
            CASE WHEN xmax IS NOT NULL THEN least(18e1, xmax) END AS xmax,
            CASE WHEN ymax IS NOT NULL THEN least(9e1, ymax) END AS ymax FROM ({STRETCHED_SQL}) q"""
    ),
)
def clamp_wgs84(spark, sf_dir):
    doubled = features(spark, sf_dir).withColumn("bbox", boxes.box(*(F.col(f"bbox.{s}") * 2 for s in boxes.SIDES)))
    return flat(doubled.withColumn("bbox", boxes.clamp_wgs84()), "fid")


@query(
    "box_polygon",
    compose(
        """SELECT fid, corner, CASE corner WHEN 1 THEN xmax WHEN 2 THEN xmax ELSE xmin END AS x,
           CASE corner WHEN 2 THEN ymax WHEN 3 THEN ymax ELSE ymin END AS y
           FROM features CROSS JOIN (VALUES (0), (1), (2), (3), (4)) v(corner)"""
    ),
)
def box_polygon(spark, sf_dir):
    rows = features(spark, sf_dir).select("fid", F.posexplode(boxes.ring()).alias("corner", "point"))
    return rows.select("fid", "corner", F.get("point", F.lit(0)).alias("x"), F.get("point", F.lit(1)).alias("y"))


MERC = "ln(tan(0.7853981633974483e0 + radians(greatest(-85e0, least(85e0, {0}))) / 2e0))"


@query(
    "mercator_xy",
    compose(
        f"""SELECT fid, round(4e0 + (radians(x) - x0) * scale, 6) AS pixel_x, round(height - 4e0 - ({MERC.format('y')} - y0) * scale, 6) AS pixel_y
            FROM (SELECT fid, (xmin + xmax) / 2e0 AS x, (ymin + ymax) / 2e0 AS y FROM features WHERE xmin IS NOT NULL) p
            CROSS JOIN (SELECT *, greatest(8, floor((y1 - y0) * scale) + 8) AS height
              FROM (SELECT *, 504e0 / greatest(x1 - x0, y1 - y0, 1e-9) AS scale
                FROM (SELECT radians(min(xmin)) AS x0, radians(max(xmax)) AS x1, {MERC.format('greatest(min(ymin), -85e0)')} AS y0,
                             {MERC.format('least(max(ymax), 85e0)')} AS y1 FROM features) a) b) c"""
    ),
)
def mercator_xy(spark, sf_dir):
    rows = features(spark, sf_dir)
    centres = rows.where("bbox.xmin is not null").select("fid", boxes.centre_x().alias("x"), boxes.centre_y().alias("y"))
    drawn = readers.pixels(centres, aggregates.global_extent(rows), "x", "y")
    return drawn.select("fid", F.round("pixel_x", 6).alias("pixel_x"), F.round("pixel_y", 6).alias("pixel_y"))


@query("multihash", "SELECT doc_id, '1220' || sha256(text) AS checksum FROM documents")
def multihash(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", codes.multihash(F.sha2("text", 256)).alias("checksum"))


def _values(names):
    listed = ", ".join("('{}', '{}')".format(code, name.replace("'", "''")) for code, name in names.items())
    return f"(VALUES {listed}) v(code, name)"


@query(
    "region_label",
    compose(
        f"""SELECT part_key, units, trim('Region ' || part_key || ' ' || coalesce(name, '')) AS label
            FROM (SELECT part_key, count(*) AS units FROM features GROUP BY part_key) f
            LEFT JOIN {_values(fixed.REGION_NAMES)} ON code = part_key"""
    ),
)
def region_label(spark, sf_dir):
    counted = features(spark, sf_dir).groupBy("part_key").agg(F.count(F.lit(1)).alias("units"))
    return codes.with_region_label(counted, "part_key")


@query(
    "state_label",
    f"""SELECT state, customers, coalesce(name, state) AS label
        FROM (SELECT left(c_mktsegment, 2) AS state, count(*) AS customers FROM customer GROUP BY 1) c
        LEFT JOIN {_values(fixed.STATE_NAMES)} ON code = state""",
)
def state_label(spark, sf_dir):
    segment = F.substring("c_mktsegment", 1, 2).alias("state")
    counted = table(spark, sf_dir, "customer").groupBy(segment).agg(F.count(F.lit(1)).alias("customers"))
    return codes.with_state_label(counted, "state")


@query(
    "level_title",
    compose(
        """SELECT level, 'WBD HUC' || level || CASE WHEN plural = '' THEN '' ELSE ' ' || plural END || ' (2026-09-02) by HUC2 region' AS title, units
           FROM (VALUES {}) v(level, plural) JOIN
             (SELECT 2 + 2 * CAST(fid % 8 AS INT) AS level, count(*) AS units FROM features GROUP BY 1) f USING (level)""".format(
            ", ".join(f"({level}, '{plural}')" for level, plural in fixed.LEVEL_NAMES.items())
        )
    ),
)
def level_title(spark, sf_dir):
    """Titles of the levels that the features' units (dealt out over eight levels) belong to."""
    level = (F.col("fid") % 8 * 2 + 2).cast("int").alias("level")
    counted = features(spark, sf_dir).groupBy(level).agg(F.count(F.lit(1)).alias("units"))
    named = counted.join(F.broadcast(codes.level_names(spark)), "level")
    return named.select("level", codes.level_title(F.col("level"), F.col("plural"), "2026-09-02").alias("title"), "units")


@query(
    "stac_type",
    """SELECT table_name, column_name AS name, CASE column_type WHEN 'VARCHAR' THEN 'varchar' WHEN 'BIGINT' THEN 'bigint'
       WHEN 'INTEGER' THEN 'integer' WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp' END AS type, rows
       FROM (SELECT 'orders' AS table_name, column_name, column_type FROM (DESCRIBE orders)
             UNION ALL SELECT 'lineitem', column_name, column_type FROM (DESCRIBE lineitem)
             UNION ALL SELECT 'documents', column_name, column_type FROM (DESCRIBE documents)) q
       JOIN (SELECT 'orders' AS table_name, count(*) AS rows FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem
             UNION ALL SELECT 'documents', count(*) FROM documents) r USING (table_name)""",
)
def stac_type(spark, sf_dir):
    """Column list and row count of each table, as an item states them."""
    listed = None
    for name in ("orders", "lineitem", "documents"):
        rows = table(spark, sf_dir, name)
        columns = codes.catalog_columns(rows).select(F.lit(name).alias("table_name"), "name", "type")
        stated = columns.withColumn("rows", aggregates.layer_count(rows).scalar())
        listed = stated if listed is None else listed.unionByName(stated)
    return listed


@query("display_projection", compose("SELECT huc12, gap_sts, area_km2 FROM features"))
def display_projection(spark, sf_dir):
    return readers.display_projection(features(spark, sf_dir), "huc12", "gap_sts", "area_km2")


@query(
    "partition_path",
    compose("SELECT DISTINCT part_key, 'units/part_key=' || part_key || '/data.parquet' AS path FROM features"),
)
def partition_path(spark, sf_dir):
    values = aggregates.partition_values(features(spark, sf_dir), KEY)
    return values.select("part_key", codes.partition_path(F.lit("units"), "part_key", F.col("part_key")).alias("path"))


@query("drop_helpers", compose(f"SELECT fid, part_key, huc12, gap_sts, area_km2, tohuc, {SIDES} FROM features"))
def drop_helpers(spark, sf_dir):
    rows = shaped_features(spark, sf_dir)
    worked = covering.with_covering(rows, GEOMETRY).withColumn("size", boxes.larger_side())
    source = [c for c in rows.columns if c != GEOMETRY]
    return flat(readers.drop_helpers(worked, source), *source)


# ---- predicates --------------------------------------------------------------------------------

CLOSED = f"xmax >= {W!r} AND xmin <= {E!r} AND ymax >= {S!r} AND ymin <= {N!r}"
OPEN = f"xmax > {W!r} AND xmin < {E!r} AND ymax > {S!r} AND ymin < {N!r}"
# Boxes snapped to whole degrees, so that some only touch the area.
SNAPPED_SQL = "SELECT fid, floor(xmin) AS xmin, floor(ymin) AS ymin, ceil(xmax) AS xmax, ceil(ymax) AS ymax FROM features"


def snapped(spark, sf_dir):
    down, up = (lambda s: F.floor(f"bbox.{s}").cast("double")), (lambda s: F.ceil(f"bbox.{s}").cast("double"))
    return features(spark, sf_dir).withColumn("bbox", boxes.box(down("xmin"), down("ymin"), up("xmax"), up("ymax")))


@query("bbox_intersects", compose(f"SELECT fid, {SIDES} FROM ({SNAPPED_SQL}) q WHERE {CLOSED}"))
def bbox_intersects(spark, sf_dir):
    return flat(snapped(spark, sf_dir).where(boxes.intersects(AREA)), "fid")


@query("bbox_overlaps", compose(f"SELECT fid, {SIDES} FROM ({SNAPPED_SQL}) q WHERE {OPEN}"))
def bbox_overlaps(spark, sf_dir):
    return flat(snapped(spark, sf_dir).where(boxes.overlaps(AREA)), "fid")


@query("min_size", compose("SELECT fid, greatest(xmax - xmin, ymax - ymin) AS size FROM features WHERE greatest(xmax - xmin, ymax - ymin) > 3e-2"))
def min_size(spark, sf_dir):
    rows = features(spark, sf_dir).where(boxes.above_size(3e-2))
    return rows.select("fid", boxes.larger_side().alias("size"))


def varied_features(spark, sf_dir):
    """Features with frequent wide boxes in some partitions."""
    grown = {s: F.col(f"bbox.{s}") + F.when(F.expr(WIDE_TEST), F.lit(d)).otherwise(0.0) for s, d in zip(boxes.SIDES, (-20.0, -20.0, 20.0, 20.0))}
    return features(spark, sf_dir).withColumn("bbox", boxes.box(*(grown[s] for s in boxes.SIDES)))


@query(
    "is_large",
    compose("SELECT fid, coalesce(size > 25e-2 * span, false) AS is_large FROM placed", VARIED, extent("varied"),
            "placed AS (SELECT v.*, greatest(xmax - xmin, ymax - ymin) AS size, greatest(e - w, n - s) AS span FROM varied v JOIN extent USING (part_key))"),
)
def is_large(spark, sf_dir):
    rows = varied_features(spark, sf_dir)
    keyed = ordering.with_curve_key(rows, aggregates.partition_extent(rows, KEY), KEY)
    return keyed.select("fid", ordering.is_large(boxes.larger_side(), F.col("span"), 0.25).alias("is_large"))


# ---- aggregates --------------------------------------------------------------------------------


@query("partition_extent", compose(f"SELECT part_key, row_count AS rows, empties AS empty_geometries, w AS xmin, s AS ymin, e AS xmax, n AS ymax FROM extent", extent("features")))
def partition_extent(spark, sf_dir):
    return aggregates.partition_extent(features(spark, sf_dir), KEY)


@query(
    "geometry_types",
    compose(f"SELECT part_key, string_agg(DISTINCT kind, ',' ORDER BY kind) AS geometry_types FROM (SELECT part_key, {KIND_SQL} AS kind FROM features) q GROUP BY part_key"),
)
def geometry_types(spark, sf_dir):
    covered = covering.with_covering(mixed_shapes(spark, sf_dir), GEOMETRY)
    return covered.groupBy("part_key").agg(F.concat_ws(",", aggregates.geometry_types()).alias("geometry_types"))


@query("empty_geometries", compose("SELECT part_key, empties AS empty_geometries FROM extent", extent("features")))
def empty_geometries(spark, sf_dir):
    covered = covering.with_covering(shaped_features(spark, sf_dir), GEOMETRY)
    return aggregates.partition_extent(covered, KEY).select("part_key", "empty_geometries")


@query(
    "key_audit",
    compose(
        f"""SELECT count(*) AS rows, count(*) FILTER (WHERE NOT regexp_full_match(coalesce(code, ''), '[0-9]{{12}}')) AS malformed,
            count(*) - count(DISTINCT code) AS duplicate_codes FROM (SELECT {CORRUPT_SQL} AS code FROM features) q"""
    ),
)
def key_audit(spark, sf_dir):
    return aggregates.key_audit(corrupt_codes(spark, sf_dir), "code", 12)


@query("partition_values", compose("SELECT DISTINCT part_key FROM features"))
def partition_values(spark, sf_dir):
    return aggregates.partition_values(features(spark, sf_dir), KEY)


@query("layer_count", compose("SELECT count(*) AS rows FROM features"))
def layer_count(spark, sf_dir):
    return aggregates.layer_count(features(spark, sf_dir))


@query(
    "global_extent",
    compose("SELECT min(xmin) AS xmin, greatest(min(ymin), -85e0) AS ymin, max(xmax) AS xmax, least(max(ymax), 85e0) AS ymax FROM features"),
)
def global_extent(spark, sf_dir):
    return aggregates.global_extent(features(spark, sf_dir))


@query(
    "collection_rollup",
    compose(
        """SELECT 'units' AS collection, CAST(sum(row_count) AS BIGINT) AS rows, count(*) AS files, greatest(-18e1, min(w)) AS xmin, greatest(-9e1, min(s)) AS ymin,
           least(18e1, max(e)) AS xmax, least(9e1, max(n)) AS ymax FROM extent""",
        extent("features"),
    ),
)
def collection_rollup(spark, sf_dir):
    facts = aggregates.partition_extent(features(spark, sf_dir), KEY).withColumn("collection", F.lit("units"))
    facts = facts.withColumn("bbox", boxes.box(*(F.col(s) for s in boxes.SIDES)))
    return flat(aggregates.collection_rollup(facts), "collection", "rows", "files")


def order_facts(spark, sf_dir):
    """Facts as a report shows them, over nations and their orders: bytes are cents of price."""
    rows = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    value = F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("value")
    cents = F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("bytes")
    facts = rows.groupBy(value).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("c_custkey").alias("row_groups"), cents)
    return codes.with_region_label(facts, "value")


ORDER_FACTS = """SELECT lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS value, count(*) AS rows, count(DISTINCT c_custkey) AS row_groups,
  CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS bytes FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1"""


@query(
    "partition_table",
    f"""SELECT value, trim('Region ' || value || ' ' || coalesce(name, '')) AS label, format('{{:,}}', rows) AS rows,
        CAST(row_groups AS VARCHAR) AS row_groups, format('{{:,}}', bytes) AS bytes
        FROM ({ORDER_FACTS}) f LEFT JOIN {_values(fixed.REGION_NAMES)} ON code = value""",
)
def partition_table(spark, sf_dir):
    return aggregates.partition_table(order_facts(spark, sf_dir))


@query("size_summary", f"SELECT format('{{:,.1f}}', sum(bytes) / 1e9) AS gigabytes FROM ({ORDER_FACTS}) f")
def size_summary(spark, sf_dir):
    return aggregates.size_summary(order_facts(spark, sf_dir))


@query(
    "row_cost",
    compose("SELECT fid, CASE WHEN xmin IS NULL THEN 0 ELSE 93 END * 1024 + attribute_cost AS cost FROM features JOIN attribute_cost USING (part_key)", mean_cost("features", 1024)),
)
def row_cost(spark, sf_dir):
    measures = layout.measure(shaped_features(spark, sf_dir), KEY, ["fid"], GEOMETRY)
    return layout.costed_rows(measures, layout.measured_extent(measures, KEY), KEY).select("fid", "cost")


# ---- documented reader queries -----------------------------------------------------------------


def unit_states(spark, sf_dir):
    """Units with the nations they touch: their own and, for two in three, the next one."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    rows = features(spark, sf_dir).join(nation, F.col("part_key").cast("int") == F.col("n_nationkey"))
    after = F.concat(F.lit(",NATION_"), ((F.col("n_nationkey") + 1) % 25).cast("string"))
    return rows.withColumn("states", F.concat("n_name", F.when(F.col("fid") % 3 > 0, after).otherwise(F.lit(""))))


@query(
    "states_explode",
    compose(
        """SELECT state, count(*) AS units FROM (SELECT unnest(string_split(n_name || CASE WHEN fid % 3 > 0
           THEN ',NATION_' || ((n_nationkey + 1) % 25) ELSE '' END, ',')) AS state
           FROM features JOIN nation ON CAST(part_key AS INT) = n_nationkey) q GROUP BY state"""
    ),
)
def states_explode(spark, sf_dir):
    rows = readers.states_explode(unit_states(spark, sf_dir))
    return rows.groupBy("state").agg(F.count(F.lit(1)).alias("units"))


@query(
    "downstream_unit",
    compose(
        """SELECT a.huc12, a.tohuc, a.area_km2, b.huc12 IS NOT NULL AS downstream_found, b.area_km2 AS downstream_area_km2
           FROM features a LEFT JOIN features b ON a.tohuc = b.huc12"""
    ),
)
def downstream_unit(spark, sf_dir):
    return readers.downstream_unit(features(spark, sf_dir), "huc12", "tohuc", ["area_km2"])


@query(
    "nested_rollup",
    compose("SELECT substr(huc12, 1, 8) AS parent, count(*) AS units, CAST(sum(CAST(area_km2 AS DECIMAL(18,2))) AS DOUBLE) AS area FROM features GROUP BY 1"),
)
def nested_rollup(spark, sf_dir):
    return readers.nested_rollup(features(spark, sf_dir), "huc12", 8, "area_km2")


@query("coverage_gap", compose("SELECT huc12, part_key FROM features WHERE gap_sts <> '3'"))
def coverage_gap(spark, sf_dir):
    units = features(spark, sf_dir)
    children = units.where("gap_sts = '3'").select(F.explode(F.array(*(F.concat("huc12", F.lit(n)) for n in ("01", "02")))).alias("huc14"))
    return readers.coverage_gap(units.select("huc12", "part_key"), children, "huc12", "huc14", 12)


@query(
    "acres_dedup",
    compose(
        """SELECT part_key, count(*) AS places, CAST(sum(acres) AS DOUBLE) AS acres FROM (
             SELECT part_key, CAST(area_km2 AS DECIMAL(18,2)) AS acres,
                    row_number() OVER (PARTITION BY part_key, fid // 40 ORDER BY gap_sts, fid) AS first_is
             FROM features) q WHERE first_is = 1 GROUP BY part_key"""
    ),
)
def acres_dedup(spark, sf_dir):
    records = features(spark, sf_dir).withColumn("place", F.expr("fid div 40"))
    return readers.acres_dedup(records, ["part_key", "place"], ["gap_sts", "fid"], "area_km2", "part_key")


@query(
    "acres_of_category",
    compose("SELECT part_key, CAST(sum(CAST(area_km2 AS DECIMAL(18,2))) AS DOUBLE) AS acres FROM features WHERE gap_sts = '2' GROUP BY part_key"),
)
def acres_of_category(spark, sf_dir):
    return readers.acres_of_category(features(spark, sf_dir), "gap_sts", "2", "area_km2", "part_key")


@query(
    "access_status",
    "SELECT gap_sts, pub_access, count(*) AS records FROM (SELECT CAST(1 + o_orderkey % 4 AS VARCHAR) AS gap_sts, left(o_orderpriority, 1) AS pub_access FROM orders) q GROUP BY 1, 2",
)
def access_status(spark, sf_dir):
    records = table(spark, sf_dir, "orders").select(
        (F.col("o_orderkey") % 4 + 1).cast("string").alias("gap_sts"), F.substring("o_orderpriority", 1, 1).alias("pub_access")
    )
    return readers.access_status(records, "gap_sts", "pub_access")
