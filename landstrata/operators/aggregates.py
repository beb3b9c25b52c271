"""Statistics per partition and per layer. All partitions come out of one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landstrata.functions import boxes, codes


def partition_extent(df: DataFrame, key: str, *more: Column) -> DataFrame:
    """Rows, rows without a box, and the box around each partition."""
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("bbox.xmin").isNull()).alias("empty_geometries"),
        *boxes.union_aggregates(),
        *more,
    )


def geometry_types(kind: Column | str = "geometry_kind") -> Column:
    """Distinct kinds, sorted, null kinds ignored (at most a kind with and without Z: 14 values)."""
    return F.sort_array(F.collect_set(kind))


def key_audit(df: DataFrame, code: str, digits: int) -> DataFrame:
    """Rows, malformed codes, and rows minus distinct codes; a null code counts as a duplicate."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~codes.code_valid(code, digits)).alias("malformed"),
        (F.count(F.lit(1)) - F.count_distinct(code)).alias("duplicate_codes"),
    )


def partition_values(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).distinct().orderBy(key)


def layer_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def global_extent(df: DataFrame, latitude_limit: float = 85.0) -> DataFrame:
    """The box around everything, its latitudes held to the Web Mercator range."""
    return df.agg(*boxes.union_aggregates()).select(
        "xmin",
        F.greatest(F.col("ymin"), F.lit(-latitude_limit)).alias("ymin"),
        "xmax",
        F.least(F.col("ymax"), F.lit(latitude_limit)).alias("ymax"),
    )


def group_stats(rows: DataFrame, key: str, *extra: str) -> DataFrame:
    """Per planned row group: rows, planned bytes, and the box around it."""
    return rows.groupBy(key, *extra, "group_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("cost").alias("cost"),
        F.max("is_large").alias("is_large"),
        *boxes.union_aggregates(),
    )


def collection_rollup(items: DataFrame, collection: str = "collection") -> DataFrame:
    """Per collection: rows, files, and the union of the boxes clamped to valid coordinates. An item
    is one file unless `files` says how many it has."""
    files = F.sum("files") if "files" in items.columns else F.count(F.lit(1))
    united = items.groupBy(collection).agg(
        F.sum("rows").alias("rows"),
        files.alias("files"),
        F.struct(*boxes.union_aggregates()).alias("bbox"),
    )
    return united.withColumn("bbox", boxes.clamp_wgs84("bbox"))


def partition_table(facts: DataFrame) -> DataFrame:
    """The report table: value, label, and counts with thousands separators."""
    return facts.select(
        "value",
        "label",
        F.format_number("rows", 0).alias("rows"),
        F.col("row_groups").cast("string").alias("row_groups"),
        F.format_number("bytes", 0).alias("bytes"),
    )


def size_summary(facts: DataFrame, by: str | None = None) -> DataFrame:
    """Total bytes in GB (1e9), one decimal, as text."""
    total = F.format_number(F.sum("bytes") / F.lit(1e9), 1).alias("gigabytes")
    return facts.groupBy(by).agg(total) if by else facts.agg(total)
