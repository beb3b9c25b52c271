"""Queries the catalog documents for its readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landstrata.functions import boxes

# Keys that a frequency sketch names at most; one with a smaller share of rows than 1 in so many is never hot.
HOT_KEYS = 1000


def money(column: Column | str) -> Column:
    """Exact two-decimal value, so that sums do not depend on the order of rows."""
    return (F.col(column) if isinstance(column, str) else column).cast("decimal(18,2)")


def display_projection(df: DataFrame, code: str, name: str, area: str) -> DataFrame:
    """What display outputs keep of a unit."""
    return df.select(code, name, area)


def drop_helpers(df: DataFrame, source_columns: list[str]) -> DataFrame:
    """All source columns and the box, without working columns."""
    return df.select(*source_columns, "bbox")


def states_explode(df: DataFrame, states: str = "states") -> DataFrame:
    """One row per unit and state; `states` is a comma-separated list."""
    return df.withColumn("state", F.explode(F.split(states, ",")))


def downstream_unit(units: DataFrame, code: str, to: str, carried: list[str], tasks: int | None = None) -> DataFrame:
    """Each unit with the unit downstream of it, one hop; null where that is not in the table.

    Codes are unique, so the right side has one row per key, but many units may drain to one. Targets
    that hold more than a small share of a task's rows are found by a frequency sketch of bounded size;
    their units are dealt to a salt each, and the target's one row is given to every salt. `tasks`
    is the number of tasks to spread over, that of the session's shuffles unless given.
    """
    tasks = tasks or int(units.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    seen = units.agg(F.count(to).alias("rows"), F.expr(f"approx_top_k(`{to}`, {HOT_KEYS}, {10 * HOT_KEYS})").alias("often")).first()
    hot = [x["item"] for x in seen["often"] or [] if x["item"] is not None and x["count"] * tasks * 4 > seen["rows"]]
    salts = 16 * tasks
    below = units.select(F.col(code).alias(to), F.lit(True).alias("downstream_found"), *(F.col(c).alias(f"downstream_{c}") for c in carried))
    own = units.select(code, to, *carried)
    if hot:
        every = F.explode(F.when(F.col(to).isin(hot), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))).alias("salt")
        below = below.select("*", every)
        own = own.withColumn("salt", F.when(F.col(to).isin(hot), F.pmod(F.xxhash64(code), F.lit(salts)).cast("int")).otherwise(0))
    joined = own.join(below, [to, "salt"] if hot else to, "left").select(code, to, *carried, "downstream_found", *(f"downstream_{c}" for c in carried))
    return joined.withColumn("downstream_found", F.coalesce("downstream_found", F.lit(False)))


def nested_rollup(units: DataFrame, code: str, digits: int, area: str) -> DataFrame:
    """Units and area by the code of the level above."""
    return units.groupBy(F.substring(code, 1, digits).alias("parent")).agg(
        F.count(F.lit(1)).alias("units"), F.sum(money(area)).cast("double").alias("area")
    )


def coverage_gap(units: DataFrame, children: DataFrame, code: str, child_code: str, digits: int) -> DataFrame:
    """Units that have no child unit: the finer level does not cover them."""
    covered = children.select(F.substring(child_code, 1, digits).alias(code)).distinct()
    return units.join(covered, code, "left_anti")


def acres_of_category(records: DataFrame, category: str, value: str, acres: str, by: str) -> DataFrame:
    """Acres of one category, which does not overlap itself."""
    kept = records.where(F.col(category) == value)
    return kept.groupBy(by).agg(F.sum(money(acres)).cast("double").alias("acres"))


def acres_dedup(records: DataFrame, place: list[str], preference: list[str], acres: str, by: str) -> DataFrame:
    """Acres with each place counted once, by its first record in order of preference.

    The first record is an aggregate, not a window, so a place with very many records is reduced
    before it is shuffled. `by` depends on the place.
    """
    first = F.min_by(money(acres), F.struct(*preference)).alias("_acres")
    once = records.groupBy(by, *(p for p in place if p != by)).agg(first)
    return once.groupBy(by).agg(F.count(F.lit(1)).alias("places"), F.sum("_acres").cast("double").alias("acres"))


def access_status(records: DataFrame, *by: str) -> DataFrame:
    """Counts by conservation status and access."""
    return records.groupBy(*by).agg(F.count(F.lit(1)).alias("records"))


def pixels(points: DataFrame, extent: DataFrame, x: str, y: str, long_side: int = 504, margin: int = 4) -> DataFrame:
    """Web Mercator pixel of each point in a picture of the extent, its long side `long_side` pixels.

    `extent` is one row (a global aggregate), used as a scalar.
    """
    x0, x1 = F.radians("xmin").alias("x0"), F.radians("xmax").alias("x1")
    y0, y1 = boxes.mercator_y(F.col("ymin")).alias("y0"), boxes.mercator_y(F.col("ymax")).alias("y1")
    frame = extent.select(F.struct(x0, x1, y0, y1).alias("frame"))
    placed = points.withColumn("_frame", frame.scalar())
    width, height = F.col("_frame.x1") - F.col("_frame.x0"), F.col("_frame.y1") - F.col("_frame.y0")
    scale = F.lit(float(long_side)) / F.greatest(width, height, F.lit(1e-9))
    tall = F.greatest(F.lit(8), F.floor(height * scale) + 2 * margin)
    return placed.withColumns(
        {
            "pixel_x": F.lit(float(margin)) + (F.radians(x) - F.col("_frame.x0")) * scale,
            "pixel_y": tall - F.lit(float(margin)) - (boxes.mercator_y(F.col(y)) - F.col("_frame.y0")) * scale,
        }
    ).drop("_frame")
