"""Catalog documents made from tables, as sorted pieces of text that a task streams to their file.

A document lists partitions or files, of which there can be any number. So no list is ever one row: a
document is rows (path, section, name, text), and `files.write_documents` writes them in that order, with
commas between the entries of a list. What a document says beside its lists is one small JSON text, cut
where the lists go.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landstrata.functions import boxes, codes, fixed
from landstrata.operators import aggregates

PIECE_TYPE = "path string, section int, name string, text string"
_MARK = r'"@@[a-z]+[0-9]*@@"'


@dataclass(frozen=True)
class CollectionSpec:
    """What a collection's documents say beyond what is computed."""

    id: str
    title: str
    description: str
    hive_key: str
    key_description: str
    geometry: str
    crs_code: str
    datetime: str
    via: str = ""
    keywords: tuple[str, ...] = ()
    providers: tuple[dict, ...] = ()
    column_descriptions: dict[str, str] = field(default_factory=dict)
    version_message: str = "Initial build"
    base_url: str = ""
    license: str = "other"
    license_url: str = ""
    license_title: str = "Terms of use"


class Listed(NamedTuple):
    """Entries (name, text) of one list or map, in the order of their names, and what stands around them."""

    entries: DataFrame
    opens: str = ""
    closes: str = ""


def _mark(name: str) -> str:
    return f"@@{name}@@"


def _quoted(text: Column) -> Column:
    """A text as JSON."""
    inside = F.to_json(F.array(text))
    return F.substring(inside, F.lit(2), F.length(inside) - 2)


def _pieces(spark: SparkSession, path: str, skeleton: dict, lists: dict[str, Listed]) -> DataFrame:
    """One document: its JSON text, cut at the marks, with a list's entries at each."""
    text = json.dumps(skeleton, ensure_ascii=False, separators=(",", ":"))
    order = [m[3:-3] for m in re.findall(_MARK, text)]
    parts = re.split(_MARK, text)
    around = [Listed(None)] + [lists[name] for name in order] + [Listed(None)]
    own = [(path, 2 * i, "", around[i].closes + part + around[i + 1].opens) for i, part in enumerate(parts)]
    out = spark.createDataFrame(own, PIECE_TYPE)
    for i, name in enumerate(order):
        out = out.unionByName(lists[name].entries.select(F.lit(path).alias("path"), F.lit(2 * i + 1).alias("section"), "name", "text"))
    return out


def _fixed(spark: SparkSession, *texts: str) -> DataFrame:
    """Entries whose text is known, in the order given."""
    return spark.createDataFrame([(f"{i:04d}", text) for i, text in enumerate(texts)], "name string, text string")


def _link(rel: str, href: str, kind: str, title: str | None = None) -> str:
    link = {"rel": rel, "href": href, "type": kind, "title": title}
    return json.dumps({k: v for k, v in link.items() if v is not None}, ensure_ascii=False, separators=(",", ":"))


def _link_column(rel: str, href: Column, kind: str, title: Column) -> Column:
    return F.to_json(F.struct(F.lit(rel).alias("rel"), href.alias("href"), F.lit(kind).alias("type"), title.alias("title")))


def column_list(written: DataFrame, spec: CollectionSpec) -> list[dict]:
    """The columns of the files with catalog types; schema metadata, so it fits on the driver."""
    rows = codes.catalog_columns(written, spec.column_descriptions).orderBy("position").collect()
    return [{k: v for k, v in r.asDict().items() if k != "position" and v is not None} for r in rows]


def _item_id(spec: CollectionSpec) -> Column:
    return F.concat(F.lit(f"{spec.hive_key}="), "value")


def _item_path(spec: CollectionSpec) -> Column:
    return F.concat(F.lit(f"{spec.id}/"), _item_id(spec), F.lit("/"), _item_id(spec), F.lit(".json"))


def item_documents(facts: DataFrame, files: DataFrame, spec: CollectionSpec, columns: list[dict]) -> DataFrame:
    """One catalog record per partition. A partition without a box has no `bbox` and a null geometry."""
    name = F.regexp_extract("path", r"([^/]+)\.parquet$", 1)
    asset = F.struct(
        F.concat(F.lit("./"), name, F.lit(".parquet")).alias("href"),
        F.lit(fixed.PARQUET_TYPE).alias("type"),
        F.concat("label", F.lit(" (GeoParquet)")).alias("title"),
        F.array(F.lit("data")).alias("roles"),
        F.col("bytes").alias("file:size"),
        codes.multihash(F.col("sha256")).alias("file:checksum"),
        F.lit(spec.crs_code).alias("proj:code"),
    )
    labels = facts.select(F.col("value").alias("part"), "label")
    assets = files.join(labels, "part").withColumn("value", F.col("part")).select(
        _item_path(spec).alias("path"), F.lit(1).alias("section"), name.alias("name"),
        F.concat(_quoted(name), F.lit(":"), F.to_json(asset)).alias("text"),
    )

    rows = facts.withColumn("bbox", boxes.clamp_wgs84("bbox"))
    placed = F.col("bbox.xmin").isNotNull()
    shape = F.to_json(F.struct(F.lit("Polygon").alias("type"), F.array(boxes.ring("bbox")).alias("coordinates")))
    links = [
        _link("root", "../../../catalog.json", fixed.JSON_TYPE), _link("parent", "../collection.json", fixed.JSON_TYPE),
        _link("collection", "../collection.json", fixed.JSON_TYPE),
    ]
    properties = F.to_json(
        F.struct(
            F.concat(F.lit(f"{spec.title}: "), "label").alias("title"),
            F.lit(spec.datetime).alias("datetime"),
            F.col("value").alias(spec.hive_key),
            F.col("rows").alias("table:row_count"),
            F.lit(spec.geometry).alias("table:primary_geometry"),
            F.from_json(F.lit(json.dumps(columns)), "array<struct<name:string,type:string,description:string>>").alias("table:columns"),
        )
    )
    said = lambda value: json.dumps(value, ensure_ascii=False, separators=(",", ":"))
    head = F.concat(
        F.lit(f'{{"type":"Feature","stac_version":{said(fixed.STAC_VERSION)},"stac_extensions":{said([fixed.FILE_SCHEMA, fixed.TABLE_SCHEMA, fixed.PROJ_SCHEMA])},"id":'),
        _quoted(_item_id(spec)), F.lit(f',"collection":{said(spec.id)},"geometry":'), F.when(placed, shape).otherwise("null"),
        F.when(placed, F.concat(F.lit(',"bbox":'), F.to_json(boxes.as_list("bbox")))).otherwise(""),
        F.lit(',"properties":'), properties, F.lit(f',"links":[{",".join(links)}],"assets":{{'),
    )
    ends = F.explode(F.array(F.struct(F.lit(0).alias("section"), head.alias("text")), F.struct(F.lit(2).alias("section"), F.lit("}}").alias("text"))))
    around = rows.select(_item_path(spec).alias("path"), ends.alias("x"))
    return around.select("path", "x.section", F.lit("").alias("name"), "x.text").unionByName(assets)


def collection_document(facts: DataFrame, spec: CollectionSpec, columns: list[dict], updated: str) -> DataFrame:
    """One record for the collection: column list, totals, united box, links to its items."""
    spark = facts.sparkSession
    rollup = aggregates.collection_rollup(facts)
    value = lambda text: Listed(rollup.select(F.lit("").alias("name"), text.alias("text")))
    href = F.concat(F.lit("./"), _item_id(spec), F.lit("/"), _item_id(spec), F.lit(".json"))
    item = _link_column("item", href, fixed.GEOJSON_TYPE, F.concat(F.lit(f"{spec.title}: "), "label"))
    before = _fixed(spark, _link("root", "../../catalog.json", fixed.JSON_TYPE), _link("parent", "../catalog.json", fixed.JSON_TYPE))
    after = ([_link("via", spec.via, "text/html", "Original source")] if spec.via else []) + (
        [_link("license", spec.license_url, "text/html", spec.license_title)] if spec.license_url else []
    )
    links = before.select(F.concat(F.lit("0"), "name").alias("name"), "text")
    links = links.unionByName(facts.select(F.concat(F.lit("1"), "value").alias("name"), item.alias("text")))
    if after:
        links = links.unionByName(_fixed(spark, *after).select(F.concat(F.lit("2"), "name").alias("name"), "text"))
    glob = f"{spec.base_url.rstrip('/')}/{spec.id}" if spec.base_url else "."
    skeleton = {
        "type": "Collection",
        "stac_version": fixed.STAC_VERSION,
        "stac_extensions": [fixed.CATALOG_SCHEMA, fixed.PARTITION_SCHEMA, fixed.FILE_SCHEMA, fixed.TABLE_SCHEMA, fixed.PROJ_SCHEMA],
        "id": spec.id,
        "title": spec.title,
        "description": spec.description,
        "license": spec.license,
        "keywords": list(spec.keywords),
        "providers": list(spec.providers),
        "extent": {"spatial": {"bbox": _mark("bbox")}, "temporal": {"interval": [[spec.datetime, None]]}},
        "table:columns": columns,
        "table:primary_geometry": spec.geometry,
        "table:row_count": _mark("rows"),
        "partition:scheme": "hive",
        "partition:strategy": "attribute",
        "partition:keys": [{"name": spec.hive_key, "type": "string", "description": spec.key_description}],
        "partition:file_count": _mark("files"),
        "partition:glob": f"{glob}/{spec.hive_key}=*/*.parquet",
        "links": _mark("links"),
        "updated": updated,
    }
    united = F.when(F.col("bbox.xmin").isNotNull(), F.to_json(F.array(boxes.as_list("bbox")))).otherwise("[]")
    lists = {"bbox": value(united), "rows": value(F.col("rows").cast("string")), "files": value(F.col("files").cast("string")), "links": Listed(links, "[", "]")}
    return _pieces(spark, f"{spec.id}/collection.json", skeleton, lists)


def versions_document(files: DataFrame, spec: CollectionSpec, created: str) -> DataFrame:
    """Version 1.0.0 of the collection: its files with digests and sizes, and their sorted paths."""
    entry = F.to_json(F.struct("sha256", F.col("bytes").alias("size_bytes"), F.col("path").alias("href")))
    assets = files.select(F.col("path").alias("name"), F.concat(_quoted(F.col("path")), F.lit(":"), entry).alias("text"))
    changes = files.select(F.col("path").alias("name"), _quoted(F.col("path")).alias("text"))
    version = {
        "version": "1.0.0", "created": created, "breaking": False, "message": spec.version_message,
        "assets": _mark("assets"), "changes": _mark("changes"),
    }
    skeleton = {"spec_version": "1.0.0", "current_version": "1.0.0", "versions": [version]}
    lists = {"assets": Listed(assets, "{", "}"), "changes": Listed(changes, "[", "]")}
    return _pieces(files.sparkSession, f"{spec.id}/versions.json", skeleton, lists)


def manifest_totals(inventory: DataFrame) -> DataFrame:
    """Count and bytes of the Parquet files."""
    data = inventory.where(F.col("path").endswith(".parquet"))
    return data.agg(
        F.count(F.lit(1)).alias("parquet_files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("parquet_bytes")
    )


def partition_summary(facts: DataFrame) -> DataFrame:
    """What a manifest keeps of each partition's facts; no box where the partition has none."""
    return facts.select(
        "collection",
        "value",
        "rows",
        "bytes",
        "sha256",
        F.when(F.col("bbox.xmin").isNotNull(), boxes.as_list("bbox")).alias("bbox"),
        "geometry_types",
        "empty_geometries",
        F.col("large_fraction").alias("large_feature_fraction"),
        F.col("group_bytes").alias("row_group_bytes"),
        F.col("large_rows").alias("large_feature_rows"),
        F.col("order_ok").alias("portolan_ordering_check"),
        "row_groups",
        "max_row_group_uncompressed",
    )


def manifest_document(
    facts: DataFrame, inventory: DataFrame, kind: str, built: str, parameters: dict, sources: list[dict], collections: list[str]
) -> DataFrame:
    """Facts of the named collections' partitions, parameters and sources as given, every file's digest, totals."""
    summary = partition_summary(facts)
    kept = F.to_json(F.struct(*(c for c in summary.columns if c != "collection")))
    said = summary.select("collection", F.col("value").alias("name"), kept.alias("text"))
    lists = {f"part{i}": Listed(said.where(F.col("collection") == c).drop("collection"), "[", "]") for i, c in enumerate(collections)}
    entry = F.concat(_quoted(F.col("path")), F.lit(":"), F.to_json(F.struct("bytes", "sha256")))
    lists["files"] = Listed(inventory.select(F.col("path").alias("name"), entry.alias("text")), "{", "}")
    totals = manifest_totals(inventory)
    lists["totals"] = Listed(totals.select(F.lit("").alias("name"), F.to_json(F.struct("parquet_files", "parquet_bytes")).alias("text")))
    skeleton = {
        "format": "partitioned-geoparquet", "version": 2, "kind": kind, "built": built, "sources": sources, "parameters": parameters,
        "collections": {c: _mark(f"part{i}") for i, c in enumerate(collections)}, "files": _mark("files"), "totals": _mark("totals"),
    }
    return _pieces(inventory.sparkSession, "manifest.json", skeleton, lists)


def catalog_document(children: DataFrame, catalog_id: str, title: str, description: str, updated: str, root: bool = False) -> DataFrame:
    """A catalog over its children (`name`, `title`), in the order of their names or `position`."""
    spark = children.sparkSession
    place = F.format_string("%010d", "position") if "position" in children.columns else F.col("name")
    file_name = "catalog.json" if root else "collection.json"
    child = _link_column("child", F.concat(F.lit("./"), "name", F.lit(f"/{file_name}")), fixed.JSON_TYPE, F.col("title"))
    up = "./catalog.json" if root else "../catalog.json"
    own = _fixed(spark, _link("root", up, fixed.JSON_TYPE), *([] if root else [_link("parent", up, fixed.JSON_TYPE)]))
    links = own.select(F.concat(F.lit("0"), "name").alias("name"), "text")
    links = links.unionByName(children.select(F.concat(F.lit("1"), place).alias("name"), child.alias("text")))
    skeleton = {
        "type": "Catalog", "stac_version": fixed.STAC_VERSION, "stac_extensions": [fixed.CATALOG_SCHEMA], "id": catalog_id, "title": title,
        "description": description, "links": _mark("links"), "updated": updated,
    }
    return _pieces(spark, "catalog.json", skeleton, {"links": Listed(links, "[", "]")})
