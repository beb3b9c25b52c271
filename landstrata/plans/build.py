"""The whole jobs: lay out and publish a layer, a dataset of layers, and the root over datasets."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landstrata.functions import boxes, codes, fixed
from landstrata.operators import aggregates, checks, layout
from landstrata.operators.layout import LayoutOptions
from landstrata.session import materialise, ship
from landstrata.sources import catalog, documents, files, inventory, layers, writer
from landstrata.sources.documents import CollectionSpec


@dataclass(frozen=True)
class Layer:
    """A source table and how it is published. `key` is the column whose values become partitions;
    `keep_key` says that it is a source column, which stays in the files."""

    rows: DataFrame
    spec: CollectionSpec
    key: str
    tie: tuple[str, ...]
    label: Callable[[DataFrame, str], DataFrame]
    keep_key: bool = True
    crs: dict | None = None
    code: str | None = None
    digits: int | None = None


@dataclass(frozen=True)
class Published:
    """Tables about a written layer: one row per partition, file and row group."""

    facts: DataFrame
    files: DataFrame
    groups: DataFrame


def now() -> str:
    return dt.datetime.now(dt.timezone.utc).replace(microsecond=0).isoformat().replace("+00:00", "Z")


def write_layer(
    layer: Layer, target: str, options: LayoutOptions, only: list[str] | None = None, boxless_groups: bool = False,
    in_place: bool = False,
) -> Published:
    """Lays out all partitions of a layer in one job and writes them under `target`.

    Refuses rows without a key, malformed codes, unknown or empty wanted partitions, and output that
    differs from the plan. A row group without any box has no statistics to prune by and is refused
    too, unless `boxless_groups`. `in_place`: files are written under their last names and not moved.
    """
    key, tie, spec = layer.key, list(layer.tie), layer.spec
    rows = layer.rows
    ship(rows.sparkSession)
    duplicates = None
    if layer.code:
        audit = materialise(aggregates.key_audit(rows, layer.code, layer.digits))
        checks.refuse(audit.where("malformed > 0"), f"{spec.id}: malformed {layer.code}")
        duplicates = audit.select("duplicate_codes")
    if only:
        rows = layers.only(rows, key, only)
    source = materialise(aggregates.layer_count(rows))  # reads no column
    measures = layout.measure(rows, key, tie, spec.geometry, layer.keep_key)
    checks.not_null_key_guard(measures, key)
    extent = materialise(layout.measured_extent(measures, key))
    checks.refuse(extent.groupBy().count().where("count = 0"), f"{spec.id}: the layer is empty")
    checks.refuse(checks.unsafe_keys(extent, key), f"{spec.id}: values of {key} that cannot name a folder")
    placed, chosen = layout.layout_search(layout.costed_rows(measures, extent, key), key, tie, options)
    planned = materialise(
        placed.groupBy(key).agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if("group_head").alias("row_groups"),
            F.count_if("is_large").alias("large_rows"),
            F.count_distinct(F.when(F.col("group_head"), F.col("file_no"))).alias("files"),
        )
    )
    expected = planned.agg(F.coalesce(F.sum("files"), F.lit(1))).first()[0]
    tasks = 3 * expected  # several for each file, so that few files share a task by chance
    groups = writer.write_clustered(
        rows, placed, extent.join(chosen, key), key, tie, spec.geometry, target, spec.hive_key, options, layer.crs, layer.keep_key, tasks, in_place
    )
    read_back = checks.readback_check(groups, planned.withColumnRenamed(key, "part"))
    checks.refuse(read_back.where("not agrees"), f"{spec.id}: written rows or groups differ from the plan")
    checks.refuse(checks.count_reconcile(groups, source).where("not agrees"), f"{spec.id}: written rows are not the source's")
    if not boxless_groups:
        checks.refuse(checks.stats_missing(groups), f"{spec.id}: row groups without box statistics")
    written = groups.groupBy("part", "file_no", "path").agg(
        F.sum("rows").alias("rows"),
        F.count(F.lit(1)).alias("row_groups"),
        F.max("uncompressed_bytes").alias("max_row_group_uncompressed"),
        F.first("file_bytes").alias("bytes"),
        F.first("sha256").alias("sha256"),
        F.first("schema").alias("schema"),
    )
    written = materialise(written)
    checks.refuse(
        written.agg(F.count_distinct("schema").alias("schemas")).where("schemas > 1"), f"{spec.id}: files differ in schema"
    )
    facts = partition_facts(spec, extent, planned, chosen, written, key)
    if duplicates is not None:
        facts = facts.withColumn("duplicate_codes", duplicates.scalar())
    return Published(materialise(layer.label(facts, "value")), written, groups)


def partition_facts(
    spec: CollectionSpec, extent: DataFrame, planned: DataFrame, chosen: DataFrame, written: DataFrame, key: str
) -> DataFrame:
    """The record of each partition. Its row groups are rows of their own table, as a partition can
    have any number of them. `sha256` digests the lines of its files' names and digests, as a tree's."""
    digests = inventory.tree_digest(written.select("part", "path", "bytes", "sha256"), "part").select("part", "sha256")
    sums = written.groupBy("part").agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("bytes").alias("bytes"),
        F.max("max_row_group_uncompressed").alias("max_row_group_uncompressed"),
    ).join(digests, "part")
    return (
        extent.join(planned.drop("rows", "files"), key)
        .join(chosen.select(key, "large_fraction", "group_bytes", "order_ok"), key)
        .join(sums.withColumnRenamed("part", key), key)
        .select(
            F.lit(spec.id).alias("collection"),
            F.col(key).alias("value"),
            "rows", "files", "bytes", "sha256", "row_groups", "max_row_group_uncompressed",
            "empty_geometries", "geometry_types", *boxes.SIDES,
            boxes.box(*(F.col(s) for s in boxes.SIDES)).alias("bbox"),
            "large_fraction", "group_bytes", "large_rows", "order_ok",
        )
    )


def written_columns(layer: Layer) -> DataFrame:
    """The columns of a layer's files; the key in the path is none of them unless it is a source column."""
    kept = [c for c in layer.rows.columns if c != "bbox" and (layer.keep_key or c != layer.key)]
    return layer.rows.select(*kept).withColumn("bbox", F.lit(None).cast(boxes.BOX_TYPE))


def write_collection(layer: Layer, published: Published, dataset: str, updated: str) -> None:
    """Items, collection and versions documents beside the data."""
    spec = layer.spec
    columns = documents.column_list(written_columns(layer), spec)
    texts = (
        documents.item_documents(published.facts, published.files, spec, columns)
        .unionByName(documents.collection_document(published.facts, spec, columns, updated))
        .unionByName(documents.versions_document(published.files, spec, updated))
    )
    materialise(files.write_documents(texts, dataset))


def build_dataset(
    spark: SparkSession,
    kind: str,
    layers_: list[Layer],
    target: str,
    catalog_id: str,
    title: str,
    description: str,
    options: LayoutOptions = LayoutOptions(),
    only: list[str] | None = None,
    updated: str | None = None,
    sources: tuple[dict, ...] = (),
    boxless_groups: bool = False,
) -> dict[str, Published]:
    """Builds one dataset catalog. An existing target is refused. Where a folder is renamed in one step,
    everything is written to a hidden folder beside the target, which takes its name at the end; on
    other stores files are written where they stay, and the manifest, written last, says it is whole.

    `only` keeps the partitions of these values. A value that no layer has is refused before anything is
    written; a layer that has none of them is left out, and the manifest lists it under `skipped`.
    """
    if files.exists(spark, target):
        raise FileExistsError(f"will not write over an earlier build: {target}")
    updated = updated or now()
    wanted = wanted_values(layers_, only)
    skipped = [layer.spec.id for layer in layers_ if only and not wanted[layer.spec.id]]
    layers_ = [layer for layer in layers_ if layer.spec.id not in skipped]
    renamed = files.renames_at_once(spark, target)
    staging = writer.staging_folder(target) if renamed else target
    published: dict[str, Published] = {}
    try:
        for layer in layers_:
            done = write_layer(layer, f"{staging}/{layer.spec.id}", options, wanted[layer.spec.id], boxless_groups, not renamed)
            write_collection(layer, done, staging, updated)
            published[layer.spec.id] = done
        names = [(i, layer.spec.id, layer.spec.title) for i, layer in enumerate(layers_)]
        children = spark.createDataFrame(names, "position int, name string, title string")
        top = documents.catalog_document(children, catalog_id, title, description, updated)
        materialise(files.write_documents(top, staging))
        facts = None
        for done in published.values():
            facts = done.facts if facts is None else facts.unionByName(done.facts, allowMissingColumns=True)
        listed = materialise(inventory.file_inventory(spark, staging, exclude=("manifest.json",)))
        manifest = documents.manifest_document(
            facts, listed, kind, updated, parameters(options, only, skipped), list(sources), list(published)
        )
        materialise(files.write_documents(manifest, staging))
        if renamed:
            files.rename(spark, staging, target)
    except Exception:
        files.delete(spark, staging)  # ours alone, and nothing else refers to it
        raise
    return published


def wanted_values(layers_: list[Layer], only: list[str] | None) -> dict[str, list[str] | None]:
    """Per layer, the wanted partition values that it has; values that no layer has are refused."""
    if not only:
        return {layer.spec.id: None for layer in layers_}
    found = {}
    for layer in layers_:
        rows = layer.rows.where(F.col(layer.key).isin(list(only))).select(layer.key).distinct()
        found[layer.spec.id] = sorted(r[0] for r in rows.collect())
    unknown = sorted(set(only) - {value for values in found.values() for value in values})
    if unknown:
        raise ValueError(f"unknown partition values: {unknown}")
    return found


def parameters(options: LayoutOptions, only: list[str] | None, skipped: list[str]) -> dict:
    """What a build was told, with the types it was told in, and how its files are ordered and written."""
    return {
        "row_group_bytes": options.group_bytes,
        "max_rows_per_group": options.group_rows,
        "zstd_level": options.zstd_level,
        "file_bytes": options.file_bytes,
        "large_feature_fraction_start": options.large_fraction,
        "sort": "small features before large ones, each along the Hilbert curve of their boxes' centres, then by id",
        "geoparquet": "1.1.0, WKB, bbox covering",
        "only": ",".join(only) if only else None,
        "skipped": skipped,
    }


def build_root(spark: SparkSession, root: str, catalog_id: str, title: str, description: str, updated: str | None = None) -> None:
    """The root catalog over the dataset catalogs under `root`."""
    children = materialise(catalog.scan_catalogs(spark, root))
    checks.refuse(children.groupBy().count().where("count = 0"), f"no dataset catalogs under {root}")
    document = documents.catalog_document(children, catalog_id, title, description, updated or now(), root=True)
    materialise(files.write_documents(document, root))


# What both published datasets say about their terms.
TERMS = {"license_url": fixed.USGS_TERMS, "license_title": "Terms of use of USGS data"}


def protected_areas(rows: DataFrame, release: str = "4.1", datetime: str = "2025-03-31T00:00:00Z", **more) -> Layer:
    """Protected areas by state: `State_Nm`, `OBJECTID`, `SHAPE`, longitude and latitude."""
    spec = CollectionSpec(
        id="combined", title=f"PAD-US {release} Combined by state",
        description=f"Protected areas of the United States, PAD-US {release} Combined, a folder for each state.",
        hive_key="state", key_description="Postal code of the state or territory (State_Nm); UNKF where the source names none.",
        geometry="SHAPE", crs_code="OGC:CRS84", datetime=datetime,
        keywords=("protected-areas", "public-lands", "pad-us", "usgs", "boundaries"),
        column_descriptions={
            "OBJECTID": "Number of the feature in its source; settles the order of features at one place.",
            "State_Nm": "The same code as the folder's.",
            "SHAPE": "Shape as well-known binary, longitude and latitude.",
        },
        **TERMS | {"via": fixed.PROTECTED_AREAS_PAGE} | more,
    )
    return Layer(rows, spec, "State_Nm", ("OBJECTID",), codes.with_state_label)


def watershed_units(rows: DataFrame, level: int, release: str, datetime: str, **more) -> Layer:
    """Hydrologic units of one level by region: code `huc{level}`, tie broken by code and `tnmid`."""
    code, plural = f"huc{level}", fixed.LEVEL_NAMES[level]
    title = " ".join(w for w in (f"WBD HUC{level}", plural, f"({release}) by HUC2 region") if w)
    spec = CollectionSpec(
        id=f"hu{level}", title=title, description=" ".join(
            [f"Hydrologic units with {level} digits from the Watershed Boundary Dataset of {release}, a folder for each region."]
            + [fixed.PARTIAL_NOTE] * (level in fixed.PARTIAL_LEVELS)
        ),
        hive_key="huc2", key_description=f"Region of the unit, the two digits that {code} begins with.",
        geometry="geometry", crs_code="EPSG:4269", datetime=datetime,
        keywords=("watersheds", "hydrology", "wbd", code, "usgs", "boundaries"),
        column_descriptions={
            code: f"Code of the unit, {level} digits; the folder is named after the first two.",
            "geometry": "Shape as well-known binary, NAD83 longitude and latitude.",
        },
        **TERMS | {"via": fixed.WATERSHEDS_PAGE} | more,
    )
    landed = layers.scan_layer(rows, ("objectid",), {"shape": "geometry"})
    keyed = landed.withColumn("part_key", codes.region_of(code))
    return Layer(keyed, spec, "part_key", (code, "tnmid"), codes.with_region_label, False, fixed.EPSG_4269, code, level)
