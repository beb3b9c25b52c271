"""Registered queries over the layout operators: order, cut, check, search, probe."""

from __future__ import annotations

from pyspark.sql import functions as F

from landstrata.functions import boxes
from landstrata.operators import aggregates, checks, covering, cuts, layout, ordering, pruning
from landstrata.operators.layout import LayoutOptions
from landstrata.plans.check_sql import VARIED, attempts, compose, curve, cut, mean_cost, search_attempts, verdict
from landstrata.plans.features import features, table
from landstrata.plans.queries_columns import varied_features
from landstrata.plans.registry import GROUP_BYTES, KEY, TIE, query, shared
from landstrata.session import materialise

UNIT = covering.COST_UNIT
CUT_BUDGET, CUT_ROWS = 200_000, 100_000
ROWS = 100_000
SEARCH = LayoutOptions(group_bytes=GROUP_BYTES)


def sized_features(spark, sf_dir):
    """Features ready to be ordered; a row costs its given shape size."""
    rows = features(spark, sf_dir)
    extent = aggregates.partition_extent(rows, KEY)
    keyed = ordering.with_curve_key(rows, extent, KEY).withColumn("size", boxes.larger_side())
    return keyed.withColumn("cost", F.col("wkb_bytes").cast("bigint")).withColumn(
        "is_large", ordering.is_large(F.col("size"), F.col("span"), 0.25)
    )


def cut_features(spark, sf_dir):
    """Features cut by a 200,000-byte budget, large ones last."""

    def make():
        rows = sized_features(spark, sf_dir).withColumn("budget", F.lit(CUT_BUDGET).cast("bigint"))
        ordered = ordering.in_order(rows, ordering.layout_order([KEY], TIE))
        return materialise(cuts.cut_groups(ordered, [KEY], CUT_ROWS, 10**12))

    return shared("cut features", spark, sf_dir, make)


CUT_PARTS = [curve("features"), attempts([(0, CUT_BUDGET, 0.25)]), cut("wkb_bytes", CUT_ROWS)]


@query(
    "hilbert_sort",
    compose("SELECT fid, part_key, row_number() OVER (PARTITION BY part_key ORDER BY curve NULLS LAST, fid) - 1 AS position FROM placed", curve("features")),
)
def hilbert_sort(spark, sf_dir):
    rows = features(spark, sf_dir)
    keyed = ordering.with_curve_key(rows, aggregates.partition_extent(rows, KEY), KEY).select("fid", "part_key", "curve")
    return ordering.with_position(keyed, [KEY], ordering.layout_order([KEY], TIE, large=False)).drop("curve")


@query("large_last", compose("SELECT fid, part_key, is_large, rn - 1 AS position FROM ordered", CUT_PARTS[0], CUT_PARTS[1], CUT_PARTS[2][0]))
def large_last(spark, sf_dir):
    rows = sized_features(spark, sf_dir).select("fid", "part_key", "is_large", "curve")
    return ordering.with_position(rows, [KEY], ordering.layout_order([KEY], TIE)).drop("curve")


@query("byte_budget_groups", compose("SELECT fid, part_key, rn - 1 AS position, CAST(group_id AS BIGINT) AS group_id FROM laid", *CUT_PARTS))
def byte_budget_groups(spark, sf_dir):
    return cut_features(spark, sf_dir).select("fid", "part_key", "position", "group_id")


@query(
    "text_budget_groups",
    """WITH RECURSIVE ordered AS MATERIALIZED (
         SELECT doc_id, lang, octet_length(encode(text)) AS cost, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rn FROM documents),
       steps AS (SELECT lang, rn, cost AS acc, 1 AS held, 0 AS group_id FROM ordered WHERE rn = 1
         UNION ALL
         SELECT o.lang, o.rn, CASE WHEN c.acc + o.cost > 20000 OR c.held >= 50 THEN o.cost ELSE c.acc + o.cost END,
                CASE WHEN c.acc + o.cost > 20000 OR c.held >= 50 THEN 1 ELSE c.held + 1 END,
                c.group_id + CASE WHEN c.acc + o.cost > 20000 OR c.held >= 50 THEN 1 ELSE 0 END
         FROM steps c JOIN ordered o ON o.lang = c.lang AND o.rn = c.rn + 1)
       SELECT doc_id, o.lang, CAST(group_id AS BIGINT) AS group_id FROM ordered o JOIN steps s ON s.lang = o.lang AND s.rn = o.rn""",
)
def text_budget_groups(spark, sf_dir):
    """The same cut over whole texts: 20,000 bytes and 50 documents a group, per language."""
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", F.octet_length("text").cast("bigint").alias("cost"), F.lit(False).alias("is_large"),
        F.lit(20_000).cast("bigint").alias("budget"),
    )
    ordered = ordering.in_order(rows, [F.col("lang"), F.col("doc_id")])
    return cuts.cut_groups(ordered, ["lang"], 50, 10**12).select("doc_id", "lang", "group_id")


@query(
    "group_stats",
    compose("SELECT part_key, CAST(group_id AS BIGINT) AS group_id, row_count AS rows, cost, is_large, xmin, ymin, xmax, ymax FROM grouped", *CUT_PARTS),
)
def group_stats(spark, sf_dir):
    return aggregates.group_stats(cut_features(spark, sf_dir), KEY)


PROBE_AREA = (-100.0, 30.0, -85.0, 40.0)
HIT = "coalesce(xmax >= -100.0 AND xmin <= -85.0 AND ymax >= 30.0 AND ymin <= 40.0, false)"


@query(
    "probe",
    compose(
        f"""SELECT part_key, count(*) AS row_groups, CAST(sum(row_count) AS BIGINT) AS rows, CAST(sum(cost) AS BIGINT) AS column_chunk_bytes,
            coalesce(string_agg(CAST(group_id AS VARCHAR), ',' ORDER BY group_id) FILTER (WHERE {HIT}), '') AS selected,
            count(*) FILTER (WHERE {HIT}) AS selected_groups,
            CAST(coalesce(sum(row_count) FILTER (WHERE {HIT}), 0) AS BIGINT) AS selected_rows,
            CAST(coalesce(sum(cost) FILTER (WHERE {HIT}), 0) AS BIGINT) AS selected_bytes FROM grouped GROUP BY part_key""",
        *CUT_PARTS,
    ),
)
def probe(spark, sf_dir):
    """Row groups a box reader must fetch, per partition, from the planned groups."""
    report = pruning.probe(probed_groups(spark, sf_dir), PROBE_AREA, KEY)
    return report.select(
        KEY, "row_groups", "rows", "column_chunk_bytes", F.concat_ws(",", F.col("selected_row_groups").cast("array<string>")).alias("selected"),
        "selected_groups", "selected_rows", F.col("selected_compressed_bytes").alias("selected_bytes"),
    )


def probed_groups(spark, sf_dir):
    return aggregates.group_stats(cut_features(spark, sf_dir), KEY).withColumns(
        {"compressed_bytes": F.col("cost"), "uncompressed_bytes": F.col("cost"), "group_no": F.col("group_id")}
    )


@query(
    "probe_runs",
    compose(
        f"""SELECT part_key, CAST(min(group_id) AS BIGINT) AS first_group, count(*) AS groups FROM (
              SELECT part_key, group_id, group_id - row_number() OVER (PARTITION BY part_key ORDER BY group_id) AS island FROM grouped WHERE {HIT}) q
            GROUP BY part_key, island""",
        *CUT_PARTS,
    ),
)
def probe_runs(spark, sf_dir):
    """Which row groups those are, as runs of neighbours."""
    return pruning.probe_runs(probed_groups(spark, sf_dir), PROBE_AREA, KEY)


def searched(spark, sf_dir):
    """(rows, chosen layouts) of the varied features."""

    def make():
        rows = varied_features(spark, sf_dir).select("fid", "part_key", "huc12", "gap_sts", "area_km2", "tohuc", "bbox")
        measures = materialise(
            rows.select(
                "part_key", "fid", "bbox", F.lit("Polygon").alias("geometry_kind"),
                F.when(F.col("bbox.xmin").isNull(), 0).otherwise(93).cast("bigint").alias("wkb_bytes"),
                (covering.attribute_eighths(rows, "bbox") + 256).alias("attribute_eighths"),
            )
        )
        extent = layout.measured_extent(measures, KEY)
        return layout.layout_search(layout.costed_rows(measures, extent, KEY), KEY, TIE, SEARCH)

    return shared("searched", spark, sf_dir, make)


SEARCH_PARTS = [
    VARIED, curve("varied"), mean_cost("varied", UNIT), search_attempts(SEARCH.group_bytes, SEARCH.large_fraction, UNIT),
    cut(f"CASE WHEN xmin IS NULL THEN 0 ELSE 93 END * {UNIT} + (SELECT attribute_cost FROM attribute_cost c WHERE c.part_key = p.part_key)", ROWS),
    verdict(),
]
FIRST_PARTS = [*SEARCH_PARTS[:3], attempts([(0, SEARCH.group_bytes * UNIT, SEARCH.large_fraction)]), *SEARCH_PARTS[4:]]


def first_layout(spark, sf_dir):
    """The varied features cut as the first attempt has it."""

    def make():
        rows = varied_features(spark, sf_dir).select("fid", "part_key", "huc12", "gap_sts", "area_km2", "tohuc", "bbox")
        measures = rows.select(
            "part_key", "fid", "bbox", F.lit("Polygon").alias("geometry_kind"),
            F.when(F.col("bbox.xmin").isNull(), 0).otherwise(93).cast("bigint").alias("wkb_bytes"),
            (covering.attribute_eighths(rows, "bbox") + 256).alias("attribute_eighths"),
        )
        costed = layout.costed_rows(measures, layout.measured_extent(measures, KEY), KEY)
        ordered = layout.ordered_rows(costed, KEY, TIE, SEARCH.large_fraction)
        budgeted = ordered.withColumn("budget", F.lit(SEARCH.group_bytes * UNIT).cast("bigint"))
        return materialise(cuts.cut_groups(budgeted, [KEY], ROWS, 10**12))

    return shared("first layout", spark, sf_dir, make)


@query(
    "row_order_check",
    compose(
        """SELECT part_key, level, boxes, pairs, overlapping, round(mean_area, 6) AS mean_area, round(extent_area, 6) AS extent_area,
           overlapping / CAST(pairs AS DOUBLE) < 0.3 OR extent_area = 0 OR mean_area / extent_area < 0.3 AS passes FROM tests""",
        *FIRST_PARTS,
    ),
)
def row_order_check(spark, sf_dir):
    """Both levels of the order check, with their figures, on the first layout tried."""
    placed = first_layout(spark, sf_dir)
    groups = materialise(aggregates.group_stats(placed, KEY))
    tests = [
        layout.order_test(parts, [KEY]).select(F.lit(level).alias("level"), "*")
        for level, parts in (("rows", layout.chunk_boxes(placed, [KEY])), ("groups", layout.group_boxes(groups, [KEY])))
    ]
    both = tests[0].unionByName(tests[1])
    return both.withColumns({c: F.round(c, 6) for c in ("mean_area", "extent_area")})


@query(
    "layout_search",
    compose(
        f"""SELECT c.part_key, c.attempt, c.order_ok, fraction AS large_fraction, CAST(budget // {UNIT} AS BIGINT) AS group_bytes
            FROM chosen c JOIN attempts a USING (attempt)""",
        *SEARCH_PARTS,
    ),
)
def layout_search(spark, sf_dir):
    _, chosen = searched(spark, sf_dir)
    return chosen.select(KEY, "attempt", "order_ok", "large_fraction", "group_bytes")


@query(
    "layout_rows",
    compose("SELECT fid, l.part_key, rn - 1 AS position, CAST(group_id AS BIGINT) AS group_id, is_large FROM laid l JOIN chosen c ON c.part_key = l.part_key AND c.attempt = l.attempt", *SEARCH_PARTS),
)
def layout_rows(spark, sf_dir):
    """Where the chosen layout puts every row."""
    rows, _ = searched(spark, sf_dir)
    return rows.select("fid", KEY, "position", "group_id", "is_large")


@query(
    "order_report",
    compose(
        f"""SELECT l.part_key, c.order_ok, any_value(fraction) AS large_fraction, CAST(any_value(l.budget) // {UNIT} AS BIGINT) AS group_bytes,
            count(*) FILTER (WHERE is_large) AS large_rows, count(DISTINCT group_id) AS row_groups
            FROM laid l JOIN chosen c ON c.part_key = l.part_key AND c.attempt = l.attempt JOIN attempts a ON a.attempt = l.attempt
            GROUP BY l.part_key, c.order_ok""",
        *SEARCH_PARTS,
    ),
)
def order_report(spark, sf_dir):
    """Which layout each partition got, and whether its order passed."""
    rows, chosen = searched(spark, sf_dir)
    counts = rows.groupBy(KEY).agg(F.count_if("is_large").alias("large_rows"), F.count_if("group_head").alias("row_groups"))
    return checks.order_report(chosen.join(counts, KEY), KEY)


@query(
    "draw_order",
    compose(
        """SELECT fid, row_number() OVER (ORDER BY (xmax - xmin) * (ymax - ymin) DESC, xmin, ymin, xmax, ymax, md5(huc12), fid) - 1 AS place
           FROM features WHERE greatest(xmax - xmin, ymax - ymin) > 5e-2"""
    ),
)
def draw_order(spark, sf_dir):
    """Features larger than a pixel in drawing order; each feature's place over the whole table."""
    rows = features(spark, sf_dir).where(boxes.above_size(5e-2)).withColumn("all", F.lit(0))
    order = [F.col("all"), *ordering.draw_order(F.encode("huc12", "utf-8"), ["fid"])]
    return ordering.with_position(rows, ["all"], order).select("fid", F.col("position").alias("place"))
