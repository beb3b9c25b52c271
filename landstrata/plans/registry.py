"""Registered queries: name -> callable(spark, sf_dir), and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landstrata.functions import boxes, codes
from landstrata.operators.layout import LayoutOptions
from landstrata.plans import build
from landstrata.plans.features import features, shaped_features
from landstrata.session import fresh_folder, shared, ship
from landstrata.sources.documents import CollectionSpec

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        if name in QUERIES:
            raise KeyError(name)
        QUERIES[name] = lambda spark, sf_dir: function(ship(spark), sf_dir)
        if sql is not None:
            SQL[name] = sql
        return function

    return register


# What the registered queries over published data share: one build per session and input.
GROUP_BYTES = 20_000
KEY, TIE, GEOMETRY = "part_key", ["fid"], "geometry"


def units_spec() -> CollectionSpec:
    return CollectionSpec(
        id="units", title="Units", description="Features by nation", hive_key=KEY, key_description="Nation number",
        geometry=GEOMETRY, crs_code="EPSG:4269", datetime="2026-01-01T00:00:00Z", keywords=("units",),
    )


def units_layer(rows: DataFrame) -> build.Layer:
    return build.Layer(rows, units_spec(), KEY, tuple(TIE), codes.with_region_label)


def published(spark: SparkSession, sf_dir: str) -> tuple[str, build.Published]:
    """(root folder, tables) of a dataset `units-1` built from the features."""

    def make():
        root = fresh_folder(spark, "published")
        done = build.build_dataset(
            spark, "units", [units_layer(shaped_features(spark, sf_dir))], f"{root}/units-1", "units-1",
            "Units, first edition", "Features by nation", LayoutOptions(group_bytes=GROUP_BYTES),
            updated="2026-01-02T00:00:00Z", boxless_groups=True,
        )
        build.build_root(spark, root, "all", "All datasets", "Every dataset", "2026-01-03T00:00:00Z")
        return root, done["units"]

    return shared("published", spark, sf_dir, make)


ONLY = ["03", "16"]


def published_levels(spark: SparkSession, sf_dir: str) -> str:
    """A dataset of two levels of units, of which two regions are wanted and the finer level has one."""

    def make():
        target = f"{fresh_folder(spark, 'levels')}/levels"
        rows = shaped_features(spark, sf_dir).select(
            F.col("fid").alias("objectid"), F.concat(F.lit("T"), "fid").alias("tnmid"), "huc12", "area_km2", F.col(GEOMETRY).alias("shape")
        )
        fine = rows.where("substring(huc12, 1, 2) < '10'").withColumn("huc14", F.concat("huc12", F.lit("01"))).drop("huc12")
        levels = [build.watershed_units(r, n, "2026-09-02", "2026-09-02T00:00:00Z") for r, n in ((rows, 12), (fine, 14))]
        build.build_dataset(
            spark, "levels", levels, target, "levels", "Levels", "Two levels", LayoutOptions(group_bytes=GROUP_BYTES), ONLY,
            updated="2026-01-02T00:00:00Z", boxless_groups=True,
        )
        return target

    return shared("levels", spark, sf_dir, make)


def flat(df: DataFrame, *columns: str) -> DataFrame:
    """Columns, and the box as four columns."""
    return df.select(*columns, *(f"bbox.{s}" for s in boxes.SIDES))


__all__ = ["QUERIES", "SQL", "features", "query", "published", "published_levels", "flat", "units_layer"]
