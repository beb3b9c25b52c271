"""What a box query has to read: partitions from item boxes, row groups from their statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landstrata.functions import boxes

# Row groups of one file whose runs are made in one window.
STRETCH = 4096


def _meets(area: tuple[float, float, float, float]):
    """Null without a box."""
    west, south, east, north = (float(v) for v in area)
    return (F.col("xmax") >= west) & (F.col("xmin") <= east) & (F.col("ymax") >= south) & (F.col("ymin") <= north)


def probe(groups: DataFrame, area: tuple[float, float, float, float], file: str = "path") -> DataFrame:
    """Per file: all row groups, and those a reader of `area` must fetch, with their numbers in order.
    Files without one stay, with zeros and no numbers. `probe_runs` tells the numbers as runs."""
    hit = F.coalesce(_meets(area), F.lit(False))

    def chosen(column: str):
        return F.coalesce(F.sum(F.when(hit, F.col(column))), F.lit(0)).cast("bigint")

    sized = F.max("file_bytes").alias("file_bytes") if "file_bytes" in groups.columns else None
    return groups.groupBy(file).agg(
        F.count(F.lit(1)).alias("row_groups"),
        F.sum("rows").alias("rows"),
        *([sized] if sized is not None else []),
        F.sum("compressed_bytes").alias("column_chunk_bytes"),
        F.sort_array(F.collect_list(F.when(hit, F.col("group_no")))).alias("selected_row_groups"),
        F.count_if(hit).alias("selected_groups"),
        chosen("rows").alias("selected_rows"),
        chosen("compressed_bytes").alias("selected_compressed_bytes"),
        chosen("uncompressed_bytes").alias("selected_uncompressed_bytes"),
    )


def probe_runs(groups: DataFrame, area: tuple[float, float, float, float], file: str = "path") -> DataFrame:
    """(file, first_group, groups): the row groups a reader of `area` must fetch, as runs of neighbours.

    Rows of a run share the difference of number and rank. Ranks are taken in stretches of numbers, so
    that no task sees all groups of a file; only runs that reach a stretch's border, two at most of each,
    are put together along the file.
    """
    hit = groups.where(_meets(area)).select(file, F.col("group_no").cast("bigint").alias("group_no"))
    hit = hit.withColumn("stretch", F.expr(f"group_no div {STRETCH}"))
    rank = F.row_number().over(Window.partitionBy(file, "stretch").orderBy("group_no"))
    runs = hit.withColumn("island", F.col("group_no") - rank).groupBy(file, "stretch", "island")
    runs = runs.agg(F.min("group_no").alias("first"), F.max("group_no").alias("last"))
    touches = (F.col("first") % STRETCH == 0) | ((F.col("last") + 1) % STRETCH == 0)
    along = Window.partitionBy(file).orderBy("first")
    apart = F.coalesce(F.lag("last").over(along) + 1 < F.col("first"), F.lit(True)).cast("int")
    border = runs.where(touches).withColumn("apart", apart).withColumn("run", F.sum("apart").over(along))
    border = border.groupBy(file, "run").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    whole = runs.where(~touches).select(file, "first", "last").unionByName(border.select(file, "first", "last"))
    return whole.select(file, F.col("first").alias("first_group"), (F.col("last") - F.col("first") + 1).alias("groups"))


def partitions_meeting(items: DataFrame, area: tuple[float, float, float, float]) -> DataFrame:
    """Items whose box meets an area."""
    return items.where(_meets(area))


def item_pruned(layer: DataFrame, items: DataFrame, key: str, area: tuple[float, float, float, float]) -> DataFrame:
    """Rows of the layer that meet an area, read from the partitions whose item box does.

    One plan, however many items there are: the items' values reach the scan at run time, as a
    filter on its partitions, and no job runs before the query does. Where the planner finds the
    items too large to broadcast, all partitions are read and joined.
    """
    values = partitions_meeting(items, area).select(F.col("value").alias(key))
    return layer.where(boxes.intersects(area)).join(values, key, "left_semi")
