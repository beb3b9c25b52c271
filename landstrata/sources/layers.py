"""Reading source layers and clustered layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landstrata.functions import boxes, codes
from landstrata.sources import catalog, files


def scan_layer(df: DataFrame, drop: tuple[str, ...] = (), rename: dict[str, str] | None = None) -> DataFrame:
    """A source layer as it is published: all columns, without its row id, the shape renamed."""
    return df.drop(*drop).withColumnsRenamed(rename or {})


def scan_all(spark: SparkSession, collection: str, committed: bool = True) -> DataFrame:
    """The whole collection, without the documents beside its files.

    Read as its dataset was committed: the files that the manifest beside the collection lists, and no
    others, so that neither an unfinished build nor files which a late task leaves in a partition's
    folder are seen. Without a manifest nothing was committed, and reading is refused. `committed=False`
    reads what lies in the folder, for a layer that is no dataset's. File names pass through the driver, as
    they do in every listing that Spark plans a scan from.

    The key in the path stays text (`01` must not become 1); the setting for that is read when the
    paths are listed, right here.
    """
    paths = [collection]
    if committed:
        dataset, _, name = collection.rstrip("/").rpartition("/")
        if not files.exists(spark, f"{dataset}/manifest.json"):
            raise ValueError(f"no build was committed: {dataset} has no manifest")
        paths = [f"{dataset}/{path}" for path in catalog.committed_files(spark, dataset, name)]
        if not paths:
            raise ValueError(f"the manifest of {dataset} lists no files of {name}")
    setting = "spark.sql.sources.partitionColumnTypeInference.enabled"
    settled = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        return spark.read.option("pathGlobFilter", "*.parquet").option("basePath", collection).parquet(*paths)
    finally:
        spark.conf.set(setting, settled)


def scan_partition(spark: SparkSession, collection: str, key: str, value: str, columns: list[str]) -> DataFrame:
    """One partition, some columns: the filter on the key prunes the other files."""
    return scan_all(spark, collection).where(F.col(key) == value).select(*columns)


def units_in_box(
    spark: SparkSession, collection: str, key: str, value: str, area: tuple, columns: list[str], touching: bool = True
) -> DataFrame:
    """Units of one partition that meet an area; the box test reaches the row groups' statistics."""
    test = boxes.intersects(area) if touching else boxes.overlaps(area)
    return scan_all(spark, collection).where((F.col(key) == value) & test).select(*columns)


def code_lookup(layer: DataFrame, key: str, code_column: str, code: str | Column) -> DataFrame:
    """A unit by its code, which may be a scalar subquery. The partition is implied by the code, which
    the planner cannot know, so the filter on the key is added here and one partition is read."""
    wanted = F.lit(code) if isinstance(code, str) else code
    return layer.where((F.col(key) == codes.region_of(wanted)) & (F.col(code_column) == wanted))


def only(layer: DataFrame, key: str, values: list[str], known: DataFrame | None = None) -> DataFrame:
    """A subset of partitions; unlike a plain filter, unknown values are refused."""
    known = (layer if known is None else known).select(key).distinct()
    wanted = layer.sparkSession.createDataFrame([(v,) for v in values], f"`{key}` string")
    unknown = wanted.join(known, key, "left_anti").limit(10).collect()
    if unknown:
        raise ValueError(f"unknown {key} values: {sorted(r[0] for r in unknown)}")
    return layer.where(F.col(key).isin(list(values)))
