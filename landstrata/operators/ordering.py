"""Global orders: the curve order of each partition and row positions in it.

No operator here gives a whole partition to one task. The order is produced by a range sort over all
sort columns, whose last columns are unique, so a partition that holds most of the table (or one
curve cell that does) still spreads over many tasks. A run of one partition inside one task is
called a span; positions come from the spans' counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landstrata.functions import boxes, hilbert
from landstrata.session import materialise, small_side


def with_curve_key(df: DataFrame, extent: DataFrame, key: str, *carried: str, broadcast: bool = True) -> DataFrame:
    """Adds `curve` (null without a box), `span` (the partition's larger side) and the carried columns.

    `extent` has one row per partition; it is broadcast only after it has been counted, and if `broadcast`
    allows it, for which the caller has counted what the carried columns hold.
    """
    named = extent.select(key, *(F.col(s).alias(f"_{s}") for s in boxes.SIDES), *carried)
    side = small_side(named)[0] if broadcast else materialise(named)
    limits = {s: F.col(f"_{s}") for s in boxes.SIDES}
    placed = hilbert.with_curve_index(df.join(side, key), boxes.centre_x(), boxes.centre_y(), limits, "curve")
    return (
        placed.withColumn("span", F.greatest(F.col("_xmax") - F.col("_xmin"), F.col("_ymax") - F.col("_ymin")))
        .drop(*(f"_{s}" for s in boxes.SIDES))
    )


def is_large(size: Column, span: Column, fraction: Column | float) -> Column:
    """A feature whose larger side exceeds a share of its partition's; fraction 0 disables."""
    share = F.lit(float(fraction)) if isinstance(fraction, (int, float)) else fraction
    return F.coalesce((share > 0) & (size > share * span), F.lit(False))


def layout_order(keys: list[str], tie: list[str], large: bool = True) -> list[Column]:
    """Sort columns: partition, large features last, curve order (no box last), unique tie."""
    flag = [F.col("is_large").asc()] if large else []
    return [*(F.col(k).asc() for k in keys), *flag, F.col("curve").asc_nulls_last(), *(F.col(t).asc() for t in tie)]


def in_order(df: DataFrame, order: list[Column]) -> DataFrame:
    """The table range-sorted over all executors and stored, with `row_at`: a number that grows
    along the order and whose upper bits name the task the row was sorted in."""
    return materialise(df.orderBy(*order).withColumn("row_at", F.monotonically_increasing_id()))


def spans_of(ordered: DataFrame, keys: list[str], cost: str | None = None, large: str | None = None) -> DataFrame:
    """One row per (partition, task): its first row, its rows, cost and rows that are not large, and what came before it."""
    counted = ordered.groupBy(*keys, F.shiftright("row_at", 33).alias("slice")).agg(
        F.min("row_at").alias("first_at"),
        F.count(F.lit(1)).alias("span_rows"),
        (F.sum(cost) if cost else F.lit(0).cast("bigint")).alias("span_cost"),
        (F.count_if(~F.col(large)) if large else F.count(F.lit(1))).alias("span_small"),
    )
    earlier = Window.partitionBy(*keys).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    # One row per task, not per feature: this window is small however many rows a partition has.
    return counted.select(
        "*",
        F.coalesce(F.sum("span_rows").over(earlier), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum("span_cost").over(earlier), F.lit(0)).alias("cost_before"),
        F.lead("slice").over(Window.partitionBy(*keys).orderBy("slice")).isNotNull().alias("goes_on"),
    )


def attach(ordered: DataFrame, summary: DataFrame, on: list[str]) -> DataFrame:
    """Inner join of ordered rows with a summary table, after which the rows are still in order.

    A summary that is small enough is broadcast, which leaves every row where it is; otherwise the
    rows are shuffled and each task's part of the order is sorted again.
    """
    side, fits = small_side(summary)
    joined = ordered.join(side, on)
    if not fits:
        joined = joined.repartition(F.shiftright("row_at", 33)).sortWithinPartitions("row_at")
    return joined


def with_spans(ordered: DataFrame, spans: DataFrame, keys: list[str]) -> DataFrame:
    """Attaches the columns of `spans` (one row per partition and task) to the rows."""
    return attach(ordered.withColumn("slice", F.shiftright("row_at", 33)), spans, [*keys, "slice"])


def positions(ordered: DataFrame, keys: list[str]) -> DataFrame:
    """Adds `position`: each row's 0-based place in its partition, without a window over rows."""
    spans = spans_of(ordered, keys).select(*keys, "slice", "first_at", "rows_before")
    placed = with_spans(ordered, spans, keys)
    return placed.withColumn("position", F.col("row_at") - F.col("first_at") + F.col("rows_before")).drop(
        "slice", "first_at", "rows_before"
    )


def with_position(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Sorts a table and adds `position`."""
    return positions(in_order(df, order), keys).drop("row_at")


def draw_order(geometry: Column | str, tie: list[str] | None = None) -> list[Column]:
    """Largest box first, then its sides, then a digest of the shape: a total order on shapes."""
    digest = F.md5(geometry).asc()
    sides = [F.col(f"bbox.{s}").asc() for s in boxes.SIDES]
    return [boxes.box_area().desc(), *sides, digest, *(F.col(t).asc() for t in tie or [])]
