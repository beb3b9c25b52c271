"""Box covering of a feature table and the cost estimate of its rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landstrata.functions import boxes, wkb

# Byte costs are integers of 1/1024 byte, so that sums do not depend on their order.
COST_UNIT = 1024


def with_covering(df: DataFrame, geometry: str) -> DataFrame:
    """Adds `bbox`, `geometry_kind` (with " Z" where it has one) and drops nothing."""
    return (
        df.withColumn("_shape", wkb.shape_column(F.col(geometry)))
        .withColumn("bbox", boxes.box(*(F.col(f"_shape.{s}") for s in boxes.SIDES)))
        .withColumn("geometry_kind", wkb.kind_label(F.col("_shape.kind"), F.col("_shape.has_z")))
        .drop("_shape")
    )


def shape_bytes(geometry: str) -> Column:
    """Octets of the shape; none counts 0."""
    return F.coalesce(F.octet_length(geometry), F.lit(0)).cast("bigint")


def attribute_eighths(df: DataFrame, *without: str) -> Column:
    """Estimated columnar bytes of a row (without its shape, say), in 1/8 byte (an integer).

    Fixed widths as stored, text as its octets plus a 4-byte offset, a struct as the sum of its
    fields, one bit for each nullable column.
    """
    total = F.lit(0).cast("bigint")
    for field in df.schema.fields:
        if field.name not in without:
            total = total + _width_eighths(F.col(f"`{field.name}`"), field.dataType)
            total = total + F.lit(1 if field.nullable else 0)
    return total


def _width_eighths(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType):
        widths = [_width_eighths(column.getField(f.name), f.dataType) for f in kind.fields]
        total = F.lit(0).cast("bigint")
        for width in widths:
            total = total + width
        return total
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return (F.coalesce(F.octet_length(column), F.lit(0)) + 4).cast("bigint") * 8
    if isinstance(kind, T.ArrayType):
        return (F.greatest(F.coalesce(F.size(column), F.lit(0)), F.lit(0)) * 8 + 4).cast("bigint") * 8
    fixed_bytes = {"boolean": 0.125, "tinyint": 1, "smallint": 2, "int": 4, "float": 4, "date": 4}
    return F.lit(int(8 * fixed_bytes.get(kind.simpleString(), 8))).cast("bigint")


def mean_attribute_cost(eighths_total: str, rows: str) -> Column:
    """A partition's mean attribute bytes per row, in cost units, rounded down."""
    return F.expr(f"({eighths_total} * {COST_UNIT // 8}) div {rows}")
