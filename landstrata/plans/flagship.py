"""The flagship: features laid out along the curve, written, and read back through a box."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landstrata.functions import boxes
from landstrata.operators import aggregates, ordering
from landstrata.operators.layout import LayoutOptions
from landstrata.plans.check_sql import compose
from landstrata.plans.features import features
from landstrata.plans.registry import KEY, TIE, published, query
from landstrata.session import fresh_folder
from landstrata.sources import layers, writer

AREA = (-100.0, 30.0, -85.0, 40.0)


def write_simple(spark: SparkSession, sf_dir: str) -> str:
    rows = features(spark, sf_dir)
    keyed = ordering.with_curve_key(rows, aggregates.partition_extent(rows, KEY), KEY)
    flagged = keyed.withColumn("is_large", ordering.is_large(boxes.larger_side(), F.col("span"), 0.5)).drop("span")
    target = fresh_folder(spark, "simple")
    writer.write_clustered_simple(flagged, KEY, TIE, target, LayoutOptions())
    return target


W, S, E, N = AREA


@query(
    "box_report",
    compose(
        f"""SELECT part_key, count(*) AS units, CAST(sum(CAST(area_km2 AS DECIMAL(18,2))) AS DOUBLE) AS area, min(fid) AS first_fid
            FROM features WHERE xmax >= {W!r} AND xmin <= {E!r} AND ymax >= {S!r} AND ymin <= {N!r} GROUP BY part_key"""
    ),
)
def box_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, _ = published(spark, sf_dir)
    found = layers.scan_all(spark, f"{root}/units-1/units").where(boxes.intersects(AREA))
    return found.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("units"),
        F.sum(F.col("area_km2").cast("decimal(18,2)")).cast("double").alias("area"),
        F.min("fid").alias("first_fid"),
    )
