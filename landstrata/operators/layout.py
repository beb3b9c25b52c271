"""Layout of a feature table: measures, order check, and the search for a layout that passes it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landstrata.functions import boxes
from landstrata.operators import aggregates, covering
from landstrata.operators.cuts import cut_groups
from landstrata.operators.ordering import in_order, is_large, layout_order, with_curve_key
from landstrata.session import materialise, materialise_observing, small_side

MAX_GROUP_ROWS = 150_000


@dataclass(frozen=True)
class LayoutOptions:
    """How a table is cut. `file_bytes` splits a partition into several files; up to that size it is
    one file. Byte sizes are uncompressed."""

    group_bytes: int = 2 * 1024 * 1024
    group_rows: int = 100_000
    large_fraction: float = 0.5
    zstd_level: int = 9
    file_bytes: int = 1024 * 1024 * 1024

    def __post_init__(self) -> None:
        if self.group_rows > MAX_GROUP_ROWS:
            raise ValueError(f"row groups are capped at {MAX_GROUP_ROWS:,} rows")

    def fractions(self) -> list[float]:
        return [self.large_fraction / 2**k for k in range(4)] if self.large_fraction > 0 else [0.0]

    def budgets(self) -> list[int]:
        return [self.group_bytes, self.group_bytes // 2, self.group_bytes // 4]


def measure(df: DataFrame, key: str, tie: list[str], geometry: str, keep_key: bool = True) -> DataFrame:
    """The narrow columns a layout needs, stored: the shapes themselves are read once, here."""
    without = [geometry] if keep_key else [geometry, key]
    bbox_width = 8 * 32
    covered = covering.with_covering(df, geometry)
    return materialise(
        covered.select(
            key,
            *tie,
            "bbox",
            "geometry_kind",
            covering.shape_bytes(geometry).alias("wkb_bytes"),
            (covering.attribute_eighths(df, *without) + bbox_width).alias("attribute_eighths"),
        )
    )


def measured_extent(measures: DataFrame, key: str) -> DataFrame:
    """Partition extent, kinds, and the mean attribute cost of a row, in one pass."""
    extent = aggregates.partition_extent(
        measures,
        key,
        F.sum("attribute_eighths").alias("eighths"),
        aggregates.geometry_types().alias("geometry_types"),
    )
    return extent.withColumn("attribute_cost", covering.mean_attribute_cost("eighths", "rows")).drop("eighths")


def costed_rows(measures: DataFrame, extent: DataFrame, key: str) -> DataFrame:
    """Rows with curve key, size and cost, ready to be ordered."""
    cost = F.col("wkb_bytes") * covering.COST_UNIT + F.col("attribute_cost")
    return (
        with_curve_key(measures, extent, key, "rows", "empty_geometries", "attribute_cost")
        .withColumn("size", boxes.larger_side())
        .withColumn("cost", cost.cast("bigint"))
        .drop("attribute_cost", "wkb_bytes", "attribute_eighths", "geometry_kind")
    )


def order_test(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Tests a sequence of boxes (`seq` dense from 0) per key.

    It passes when fewer than 30% of consecutive boxes overlap on their interiors, when the boxes
    average under 30% of the whole extent, or when that extent has no area. Two boxes overlap when
    the least of their maxima exceeds the greatest of their minima, so consecutive pairs are formed
    by sending each box to the pairs on either side: no window over a whole partition, no self-join.
    """
    sides = [F.col(s) for s in boxes.SIDES]
    paired = parts.select(*keys, F.explode(F.array("seq", F.col("seq") + 1)).alias("pair"), *sides)
    pairs = paired.groupBy(*keys, "pair").agg(
        F.count(F.lit(1)).alias("members"),
        ((F.min("xmax") > F.max("xmin")) & (F.min("ymax") > F.max("ymin"))).alias("overlaps"),
    )
    shared = (
        pairs.where("members = 2")
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("pairs"), F.count_if("overlaps").alias("overlapping"))
    )
    area = (F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin"))
    whole = parts.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("boxes"),
        F.avg(area).alias("mean_area"),
        ((F.max("xmax") - F.min("xmin")) * (F.max("ymax") - F.min("ymin"))).alias("extent_area"),
    )
    few = F.col("overlapping") / F.col("pairs") < 0.3
    small = F.col("mean_area") / F.nullif(F.col("extent_area"), F.lit(0.0)) < 0.3
    passes = F.coalesce(few, F.lit(False)) | (F.col("extent_area") == 0) | F.coalesce(small, F.lit(False))
    joined = whole.join(shared, keys, "left").na.fill(0, ["pairs", "overlapping"])
    return joined.withColumn("passes", passes)


def chunk_boxes(placed: DataFrame, keys: list[str]) -> DataFrame:
    """Row level: the rows that have a box, in ten equal chunks, where there are at least 200.

    Rows without a box lie between the others and the large ones, so a row's place among the rows
    that have one needs no second ranking.
    """
    present = F.col("rows") - F.col("empty_geometries")
    place = F.col("position") - F.when(F.col("is_large"), F.col("empty_geometries")).otherwise(0)
    chunk = F.floor(place / F.ceil(present / 10)).cast("bigint")
    return (
        placed.where(F.col("bbox.xmin").isNotNull() & (present >= 200))
        .withColumn("seq", chunk)
        .groupBy(*keys, "seq")
        .agg(*boxes.union_aggregates())
    )


def group_boxes(groups: DataFrame, keys: list[str]) -> DataFrame:
    """Row-group level: the boxes of the groups that have one, where there are at least five."""
    counts = groups.groupBy(*keys).agg(
        F.count_if(F.col("xmin").isNull()).alias("_none"), F.count(F.lit(1)).alias("_groups")
    )
    side, _ = small_side(counts)
    place = F.col("group_id") - F.when(F.col("is_large"), F.col("_none")).otherwise(0)
    return (
        groups.join(side, keys)
        .where(F.col("xmin").isNotNull() & (F.col("_groups") - F.col("_none") >= 5))
        .withColumn("seq", place)
        .select(*keys, "seq", *boxes.SIDES)
    )


def order_check(placed: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """`ok` per layout: the rows' order and the row groups both pass, where they are enough to test."""
    row_test = order_test(chunk_boxes(placed, keys), keys).select(*keys, F.col("passes").alias("rows_ok"))
    group_test = order_test(group_boxes(groups, keys), keys).select(*keys, F.col("passes").alias("groups_ok"))
    return (
        groups.select(*keys)
        .distinct()
        .join(row_test, keys, "left")
        .join(group_test, keys, "left")
        .na.fill(True, ["rows_ok", "groups_ok"])
        .withColumn("ok", F.col("rows_ok") & F.col("groups_ok"))
    )


def ordered_rows(costed: DataFrame, key: str, tie: list[str], fraction: float | Column, *more: str) -> DataFrame:
    """Rows in layout order for one large-feature fraction, stored."""
    flagged = costed.withColumn("is_large", is_large(F.col("size"), F.col("span"), fraction)).drop("size", "span")
    return in_order(flagged, layout_order([key, *more], tie))


def try_layouts(
    costed: DataFrame, key: str, tie: list[str], options: LayoutOptions, attempts: list[tuple[int, int, float]]
) -> tuple[DataFrame, DataFrame, int]:
    """Cuts the rows for each attempt (number, budget, fraction) and checks their order.

    Returns the cut rows and one verdict per partition and attempt, both with `attempt`, and the
    number of verdicts that fail. The order depends on the fraction only, so attempts that differ in
    their budget share a sort.
    """
    unit = covering.COST_UNIT
    fractions = sorted({fraction for _, _, fraction in attempts}, reverse=True)
    tried = costed
    if len(fractions) > 1:
        tries = F.explode(F.array(*(F.lit(fraction) for fraction in fractions)))
        tried = costed.withColumn("fraction", tries)
    else:
        tried = costed.withColumn("fraction", F.lit(fractions[0]))
    ordered = ordered_rows(tried, key, tie, F.col("fraction"), "fraction")
    rows = None
    for budget in sorted({budget for _, budget, _ in attempts}, reverse=True):
        numbers = {fraction: number for number, size, fraction in attempts if size == budget}
        numbered = F.coalesce(*(F.when(F.col("fraction") == f, F.lit(n)) for f, n in numbers.items()))
        mine = ordered.where(F.col("fraction").isin(list(numbers))).withColumns(
            {"attempt": numbered, "budget": F.lit(budget * unit).cast("bigint")}
        ).drop("fraction")
        cut = cut_groups(mine, [key, "attempt"], options.group_rows, options.file_bytes * unit)
        rows = cut if rows is None else rows.unionByName(cut)
    keys = [key, "attempt"]
    rows = materialise(rows)
    groups = materialise(aggregates.group_stats(rows, *keys))
    verdicts, seen = materialise_observing(order_check(rows, groups, keys), failing=F.count_if(~F.col("ok")))
    return rows, verdicts, seen["failing"]


def layout_search(costed: DataFrame, key: str, tie: list[str], options: LayoutOptions) -> tuple[DataFrame, DataFrame]:
    """Chooses each partition's layout: (rows with their groups, one verdict per partition).

    Attempts are numbered budgets outer (b, b/2, b/4), fractions inner (f, f/2, f/4, f/8); the first
    that passes the order check is kept, else the first attempt. They are tried in rounds: the fractions
    one by one, then all smaller budgets. A round takes only the partitions that have not passed, all
    together, and only their narrow rows; most partitions need one or two rounds.
    """
    fractions, budgets = options.fractions(), options.budgets()
    attempts = [
        (i * len(fractions) + j, budget, fraction)
        for i, budget in enumerate(budgets)
        for j, fraction in enumerate(fractions)
    ]
    rounds = [*([attempt] for attempt in attempts[: len(fractions)]), attempts[len(fractions) :]]
    laid, verdicts, open_rows = [], None, costed
    for tried in rounds:
        rows, found, failing = try_layouts(open_rows, key, tie, options, tried)
        laid.append(rows)
        verdicts = found if verdicts is None else verdicts.unionByName(found)
        if not failing:
            break
        passed = verdicts.groupBy(key).agg(F.bool_or("ok").alias("passed"))
        side, _ = small_side(passed.where("not passed").select(key))
        open_rows = costed.join(side, key, "left_semi")
    number = F.coalesce(F.min(F.when(F.col("ok"), F.col("attempt"))), F.lit(0)).alias("attempt")
    chosen = verdicts.groupBy(key).agg(number, F.bool_or("ok").alias("order_ok"))
    inner, outer = F.expr(f"attempt % {len(fractions)}"), F.expr(f"attempt div {len(fractions)}").cast("int")
    chosen = chosen.withColumns(
        {
            "large_fraction": F.get(F.array(*map(F.lit, fractions)), inner),
            "group_bytes": F.get(F.array(*map(F.lit, budgets)), outer).cast("bigint"),
        }
    )
    side, _ = small_side(chosen)
    rows = laid[0]
    for more in laid[1:]:
        rows = rows.unionByName(more)
    if len(laid) > 1:
        rows = rows.join(side.select(key, "attempt"), [key, "attempt"])
    return rows.select(key, *tie, "bbox", "curve", "cost", "is_large", "position", "group_id", "file_no", "group_head"), side
