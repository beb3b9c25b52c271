"""Reconciliation: each check returns the rows that are wrong; `refuse` turns them into an error."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class CheckFailed(ValueError):
    """A table, a build or a catalog is not what it has to be."""


def refuse(wrong: DataFrame, message: str, shown: int = 5) -> None:
    """Raises if there is any row; shows a few of them."""
    found = wrong.limit(shown).collect()
    if found:
        raise CheckFailed(f"{message}: {[r.asDict() for r in found]}")


def null_keys(df: DataFrame, key: str) -> DataFrame:
    """Rows without a partition key, counted."""
    return df.agg(F.count_if(F.col(key).isNull()).alias("null_keys"))


def not_null_key_guard(df: DataFrame, key: str) -> DataFrame:
    refuse(null_keys(df, key).where("null_keys > 0"), f"{key} is null in some rows, which so belong to no partition")
    return df


def unsafe_keys(extent: DataFrame, key: str) -> DataFrame:
    """Partition values that cannot be a folder name as they are: empty, or with a reserved character."""
    return extent.select(key).where((F.col(key) == "") | F.col(key).rlike(r"""[\x00-\x1f\x7f"#%'*/:=?\\{\[\]^]"""))


def count_reconcile(parts: DataFrame, source_rows: DataFrame) -> DataFrame:
    """One row: rows of all partitions, rows of the source, and whether they agree."""
    total = parts.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("partition_rows"))
    return total.withColumn("source_rows", source_rows.select("rows").scalar()).withColumn(
        "agrees", F.col("partition_rows") == F.col("source_rows")
    )


def readback_check(groups: DataFrame, planned: DataFrame, key: str = "part") -> DataFrame:
    """Per partition: rows and groups found in the footers against those planned."""
    found = groups.groupBy(key).agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("row_groups"))
    plan = planned.select(key, F.col("rows").alias("planned_rows"), F.col("row_groups").alias("planned_groups"))
    same = F.col("rows").eqNullSafe(F.col("planned_rows")) & F.col("row_groups").eqNullSafe(F.col("planned_groups"))
    return plan.join(found, key, "full_outer").withColumn("agrees", same)


def stats_missing(groups: DataFrame) -> DataFrame:
    """Row groups without min and max on every side of the box; a group of rows without boxes too."""
    return groups.where(~F.col("has_min_max"))


def empty_partitions(wanted: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """Wanted partition values that have no rows."""
    return wanted.select(key).distinct().join(facts.where("rows > 0").select(key), key, "left_anti")


def source_pin(found: DataFrame, pins: DataFrame, name: str, allow_unpinned: bool = False) -> DataFrame:
    """Sources whose files, bytes or digest differ from their pins. `allow_unpinned` reports them as
    accepted, with the digest that was found."""
    measured = ("files", "bytes", "sha256")
    pinned = pins.select(name, *(F.col(c).alias(f"pinned_{c}") for c in measured))
    same = F.lit(True)
    for column in measured:
        same = same & F.col(column).eqNullSafe(F.col(f"pinned_{column}"))
    return (
        pinned.join(found.select(name, *measured), name, "left")
        .withColumn("matches", same)
        .withColumn("accepted", F.col("matches") | F.lit(allow_unpinned))
    )


def manifest_vs_listing(manifest: DataFrame, listing: DataFrame, limit: int | None = None) -> DataFrame:
    """Manifest entries that are missing, have another size or other content. With a `limit`, the
    content of files of that size or more is not compared."""
    live = listing.select("path", F.col("bytes").alias("live_bytes"), F.col("sha256").alias("live_sha256"))
    compared = F.lit(True) if limit is None else F.col("bytes") < limit
    reason = (
        F.when(F.col("live_bytes").isNull(), "missing")
        .when(F.col("live_bytes") != F.col("bytes"), "bytes differ")
        .when(compared & ~F.col("live_sha256").eqNullSafe(F.col("sha256")), "sha256 differs")
    )
    return manifest.join(live, "path", "left").withColumn("problem", reason).where(F.col("problem").isNotNull())


def tree_diff(
    ours: DataFrame, theirs: DataFrame, ignore_names: tuple[str, ...] = (), ignore_suffixes: tuple[str, ...] = ()
) -> DataFrame:
    """Paths that are in one tree only or differ in content. A name is ignored at any depth."""

    def kept(tree: DataFrame) -> DataFrame:
        for suffix in ignore_suffixes:
            tree = tree.where(~F.col("path").endswith(suffix))
        if ignore_names:
            tree = tree.where(~F.arrays_overlap(F.split("path", "/"), F.array(*map(F.lit, ignore_names))))
        return tree

    left = kept(ours).select("path", F.col("bytes").alias("our_bytes"), F.col("sha256").alias("our_sha256"))
    right = kept(theirs).select("path", F.col("bytes").alias("their_bytes"), F.col("sha256").alias("their_sha256"))
    difference = (
        F.when(F.col("our_sha256").isNull(), "only theirs")
        .when(F.col("their_sha256").isNull(), "only ours")
        .when(
            (F.col("our_bytes") != F.col("their_bytes")) | (F.col("our_sha256") != F.col("their_sha256")), "differ"
        )
    )
    return (
        left.join(right, "path", "full_outer")
        .withColumn("difference", difference)
        .where(F.col("difference").isNotNull())
        .select("path", "difference")
    )


def item_version_agree(item_assets: DataFrame, versions: DataFrame) -> DataFrame:
    """Per published file: do the item and the versions document give the same bytes and digest?"""
    left = item_assets.select("collection", "path", F.col("bytes").alias("item_bytes"), F.col("sha256").alias("item_sha256"))
    right = versions.select("collection", "path", "size_bytes", F.col("sha256").alias("version_sha256"))
    same = F.col("item_bytes").eqNullSafe(F.col("size_bytes")) & F.col("item_sha256").eqNullSafe(F.col("version_sha256"))
    return left.join(right, ["collection", "path"], "full_outer").withColumn("agrees", same)


def schema_agree(items: DataFrame) -> DataFrame:
    """Per collection: number of different column lists among its items (1 is right)."""
    return items.groupBy("collection").agg(F.count_distinct("columns").alias("schemas"))


def order_report(facts: DataFrame, key: str = "value") -> DataFrame:
    """Which layout each partition got, and whether its order passed."""
    return facts.select(key, "large_fraction", "group_bytes", "large_rows", "row_groups", "order_ok")
