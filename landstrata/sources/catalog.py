"""Catalog documents as tables. Every schema is given, so nothing is inferred from the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landstrata.session import materialise
from landstrata.sources import split_json

_COLUMN = "struct<name: string, type: string, description: string>"
ITEM_TYPE = (
    "id string, collection string, bbox array<double>, "
    "properties struct<title: string, datetime: string, `table:row_count`: bigint, "
    f"`table:primary_geometry`: string, `table:columns`: array<{_COLUMN}>>, "
    "assets map<string, struct<href: string, type: string, title: string, `file:size`: bigint, "
    "`file:checksum`: string, `proj:code`: string>>"
)
COLLECTION_TYPE = (
    "id string, title string, license string, "
    "extent struct<spatial: struct<bbox: array<array<double>>>, temporal: struct<interval: array<array<string>>>>, "
    f"`table:columns` array<{_COLUMN}>, `table:row_count` bigint, `partition:file_count` bigint, `partition:glob` string"
)
VERSIONS_TYPE = (
    "spec_version string, current_version string, versions array<struct<version: string, created: string, "
    "breaking: boolean, message: string, "
    "assets: map<string, struct<sha256: string, size_bytes: bigint, href: string>>, changes: array<string>>>"
)
MANIFEST_TYPE = (
    "kind string, built string, parameters struct<row_group_bytes: bigint, max_rows_per_group: bigint, zstd_level: int, "
    "file_bytes: bigint, large_feature_fraction_start: double, sort: string, geoparquet: string, only: string, skipped: array<string>>, "
    "files map<string, struct<bytes: bigint, sha256: string>>, "
    "totals struct<parquet_files: bigint, parquet_bytes: bigint>, "
    "collections map<string, array<struct<value: string, rows: bigint, row_groups: bigint, "
    "max_row_group_uncompressed: bigint, portolan_ordering_check: boolean>>>"
)
CATALOG_TYPE = "id string, title string, description string, links array<struct<rel: string, href: string, type: string, title: string>>"


def _documents(spark: SparkSession, pattern: str, schema: str) -> DataFrame:
    return spark.read.option("multiLine", "true").schema(schema).json(pattern)


def _parent(up: int = 1):
    return F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1 - up)


def scan_items(spark: SparkSession, dataset: str) -> DataFrame:
    """One row per item: collection, id, partition value, box, rows, asset map, column list."""
    raw = _documents(spark, f"{dataset}/*/*=*/*.json", ITEM_TYPE)
    return raw.select(
        "collection",
        "id",
        F.element_at(F.split("id", "="), -1).alias("value"),
        F.col("properties.title").alias("title"),
        *(F.get("bbox", F.lit(i)).alias(s) for i, s in enumerate(("xmin", "ymin", "xmax", "ymax"))),
        F.col("properties.`table:row_count`").alias("rows"),
        "assets",
        F.to_json("properties.`table:columns`").alias("columns"),
    )


def item_assets(items: DataFrame) -> DataFrame:
    """One row per data file named by an item; the digest without its multihash prefix."""
    return items.select("collection", "id", F.explode("assets").alias("name", "asset")).select(
        "collection",
        F.concat("id", F.lit("/"), F.regexp_replace("asset.href", r"^\./", "")).alias("path"),
        F.col("asset.`file:size`").alias("bytes"),
        F.substring("asset.`file:checksum`", 5, 64).alias("sha256"),
    )


def scan_collections(spark: SparkSession, dataset: str) -> DataFrame:
    raw = _documents(spark, f"{dataset}/*/collection.json", COLLECTION_TYPE)
    box = F.get(F.col("extent.spatial.bbox"), F.lit(0))
    return raw.select(
        F.col("id").alias("collection"),
        "title",
        F.col("`table:row_count`").alias("rows"),
        F.col("`partition:file_count`").alias("files"),
        *(F.get(box, F.lit(i)).alias(s) for i, s in enumerate(("xmin", "ymin", "xmax", "ymax"))),
        F.to_json("`table:columns`").alias("columns"),
    )


FILE_TYPE = "map<string, struct<bytes: bigint, sha256: string>>"
ASSET_TYPE = "map<string, struct<sha256: string, size_bytes: bigint, href: string>>"


def _member(kind: str) -> Column:
    """(name, value) of the text of one member of an object."""
    return F.explode(F.from_json(F.concat(F.lit("{"), "text", F.lit("}")), kind)).alias("path", "value")


def _folder(up: int = 1) -> Column:
    return F.element_at(F.split("file", "/"), -1 - up)


def scan_versions(spark: SparkSession, dataset: str) -> DataFrame:
    """One row per file of each version of each collection. A document is read by many tasks, entry by entry."""
    cut = materialise(split_json.pieces(spark, f"{dataset}/*/versions.json"))
    assets = split_json.entries(cut, 4, "assets").select("file", "parent", _member(ASSET_TYPE))
    named = split_json.entries(cut, 3, member="version").select("file", F.col("section").alias("parent"), _member("map<string, string>"))
    named = named.select("file", "parent", F.col("value").alias("version"))
    return assets.join(named, ["file", "parent"]).select(
        _folder().alias("collection"), "version", "path", "value.sha256", "value.size_bytes", "value.href"
    )


def _listed(spark: SparkSession, pattern: str) -> DataFrame:
    return split_json.entries(split_json.pieces(spark, pattern), 2, "files").select("file", _member(FILE_TYPE))


def scan_manifests(spark: SparkSession, root: str) -> DataFrame:
    """One row per file of each dataset's manifest. A manifest is read by many tasks, entry by entry."""
    return _listed(spark, f"{root}/*/manifest.json").select(_folder().alias("dataset"), "path", "value.bytes", "value.sha256")


def scan_manifest(spark: SparkSession, dataset: str) -> DataFrame:
    """One row per file of one dataset's manifest."""
    return _listed(spark, f"{dataset}/manifest.json").select("path", "value.bytes", "value.sha256")


def committed_files(spark: SparkSession, dataset: str, collection: str) -> list[str]:
    """Paths of a collection's data files, as the dataset's manifest lists them.

    Planning a scan needs all of them on the driver, so the manifest is parsed there and then, as one record.
    """
    raw = _documents(spark, f"{dataset}/manifest.json", f"files {FILE_TYPE}")
    paths = raw.select(F.explode(F.map_keys("files")).alias("path"))
    return sorted(r.path for r in paths.where(F.col("path").startswith(f"{collection}/") & F.col("path").endswith(".parquet")).collect())


def scan_catalogs(spark: SparkSession, root: str) -> DataFrame:
    """Child catalogs by directory."""
    raw = _documents(spark, f"{root}/*/catalog.json", CATALOG_TYPE)
    return raw.select(_parent().alias("name"), "id", "title").orderBy("name")
