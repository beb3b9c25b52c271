"""Hilbert curve index of a point in an extent, 16 bits per axis, as one built-in expression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELLS = 65535.0  # 16 bits per axis


def _two_level_table() -> list[int]:
    """For each (orientation, two x bits, two y bits): four index bits, then the next orientation.

    An orientation is two flags: bit 1 says the axes are mirrored, bit 0 says they are swapped.
    """
    table = []
    for orientation in range(4):
        for x in range(4):
            for y in range(4):
                mirrored, swapped, digits = orientation >> 1, orientation & 1, 0
                for level in (1, 0):
                    xb, yb = (x >> level) & 1, (y >> level) & 1
                    differ = xb ^ yb
                    right = xb ^ mirrored ^ (swapped & differ)
                    digits = digits * 4 + right * 2 + differ
                    upper = right ^ differ
                    mirrored ^= right & differ
                    swapped ^= 1 - upper
                table.append(digits * 4 + mirrored * 2 + swapped)
    return table


_TABLE = ",".join(str(v) for v in _two_level_table())


def grid_cell(value: Column, low: Column, high: Column) -> Column:
    """Cell 0..65535 of a coordinate in an extent; 0 on an extent of no width, null for null."""
    scaled = F.floor((value - low) * (F.lit(CELLS) / (high - low)))
    held = F.greatest(F.lit(0), F.least(F.lit(int(CELLS)), scaled))
    # greatest and least skip nulls, so a missing coordinate is set apart first.
    return F.when(value.isNotNull(), F.when(high > low, held).otherwise(0)).cast("int")


def curve_index(x: Column, y: Column) -> Column:
    """Index along the curve of integer cells (x, y). Eight table look-ups, no loop, no Python."""
    table = F.split(F.lit(_TABLE), ",").cast("array<int>")  # folded to one literal when planned
    orientation, index = F.lit(0), F.lit(0).cast("bigint")
    for shift in range(14, -1, -2):
        xb = F.shiftright(x, shift).bitwiseAND(3)
        yb = F.shiftright(y, shift).bitwiseAND(3)
        found = F.get(table, orientation * 16 + xb * 4 + yb)
        index = index * 16 + F.shiftright(found, 2)
        orientation = found.bitwiseAND(3)
    return index


def with_curve_index(df: DataFrame, x: Column, y: Column, extent: dict[str, Column], name: str) -> DataFrame:
    """Adds the curve index of point (x, y) in `extent` (its xmin, ymin, xmax, ymax columns). The
    cells are columns of their own first, as the index refers to each many times."""
    cells = df.withColumns(
        {
            "_cell_x": grid_cell(x, extent["xmin"], extent["xmax"]),
            "_cell_y": grid_cell(y, extent["ymin"], extent["ymax"]),
        }
    )
    return cells.withColumn(name, curve_index(F.col("_cell_x"), F.col("_cell_y"))).drop("_cell_x", "_cell_y")
