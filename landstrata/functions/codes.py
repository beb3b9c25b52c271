"""Expressions over unit codes, partition names, paths and digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landstrata.functions import fixed


def region_of(code: Column | str) -> Column:
    """The partition a unit code belongs to: its first two digits."""
    return F.substring(code, 1, 2)


def code_valid(code: Column | str, digits: int) -> Column:
    r"""The whole code is `digits` decimal digits; null is invalid. `\z`, as `$` also matches before
    a final newline."""
    text = F.col(code) if isinstance(code, str) else code
    return F.coalesce(text, F.lit("")).rlike(rf"\A[0-9]{{{int(digits)}}}\z")


def multihash(sha256_hex: Column) -> Column:
    """A sha256 digest with its multihash prefix (code 12, length 20 hex)."""
    return F.concat(F.lit("1220"), sha256_hex)


def partition_path(collection: Column, key: str, value: Column, file_name: Column | None = None) -> Column:
    name = F.lit("data.parquet") if file_name is None else file_name
    return F.concat(collection, F.lit(f"/{key}="), value, F.lit("/"), name)


def state_names(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(fixed.STATE_NAMES.items()), "value string, name string")


def region_names(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(fixed.REGION_NAMES.items()), "value string, name string")


def level_names(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(fixed.LEVEL_NAMES.items()), "level int, plural string")


def with_state_label(df: DataFrame, value: str) -> DataFrame:
    """Adds `label`: the state's name, or its code where it has none. The names table is fixed, so
    it is safe to broadcast."""
    names = F.broadcast(state_names(df.sparkSession).withColumnRenamed("value", "_code"))
    joined = df.join(names, F.col(value) == F.col("_code"), "left")
    return joined.withColumn("label", F.coalesce("name", value)).drop("_code", "name")


def with_region_label(df: DataFrame, value: str) -> DataFrame:
    """Adds `label`: `Region NN Name`, without the name where it has none."""
    names = F.broadcast(region_names(df.sparkSession).withColumnRenamed("value", "_code"))
    joined = df.join(names, F.col(value) == F.col("_code"), "left")
    label = F.trim(F.concat(F.lit("Region "), F.col(value), F.lit(" "), F.coalesce("name", F.lit(""))))
    return joined.withColumn("label", label).drop("_code", "name")


def level_title(level: Column, plural: Column, release: str) -> Column:
    """`WBD HUCn plural (release) by HUC2 region`; an empty plural is left out."""
    named = F.when(plural != "", plural)
    head = F.concat(F.lit("WBD HUC"), level.cast("string"))
    return F.concat_ws(" ", head, named, F.lit(f"({release}) by HUC2 region"))


def catalog_columns(df: DataFrame, descriptions: dict[str, str] | None = None) -> DataFrame:
    """The table's columns as rows (position, name, type, description) with catalog type names.

    The schema is metadata of the plan, so this makes one row per column and reads no data.
    """
    described = descriptions or {}
    rows = []
    for position, field in enumerate(df.schema.fields):
        kind = field.dataType.simpleString()
        kind, text = fixed.CATALOG_TYPES.get(kind, kind), described.get(field.name)
        if field.name == "bbox":
            kind, text = fixed.BBOX_TYPE, fixed.BBOX_DESCRIPTION
        rows.append((position, field.name, kind, text))
    return df.sparkSession.createDataFrame(rows, "position int, name string, type string, description string")
