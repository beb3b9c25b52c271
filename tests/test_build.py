import json
import re
import shutil
import subprocess
import sys
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from landstrata.functions import boxes, codes
from landstrata.operators import checks, layout, pruning
from landstrata.operators.layout import LayoutOptions
from landstrata.plans import build
from landstrata.plans.features import features, shaped_features
from landstrata.sources import catalog, files, footers, inventory, layers
from landstrata.sources.documents import CollectionSpec

BUDGET = 4_000


def formatted(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def feature_layer(rows):
    spec = CollectionSpec(
        id="units", title="Units", description="Test units", hive_key="part_key", key_description="nation",
        geometry="geometry", crs_code="EPSG:4269", datetime="2026-01-01T00:00:00Z", keywords=("a", "b"),
    )
    return build.Layer(rows, spec, "part_key", ("fid",), codes.with_region_label)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("out")
    rows = shaped_features(spark, "/root/testdata/sf0.001")
    options = LayoutOptions(group_bytes=BUDGET, file_bytes=5_000)
    out = build.build_dataset(
        spark, "units", [feature_layer(rows)], f"{root}/units-1", "units-1", "Units one", "d", options,
        updated="2026-01-02T00:00:00Z", boxless_groups=True,
    )
    build.build_root(spark, str(root), "all", "All", "d", "2026-01-03T00:00:00Z")
    return root, out["units"]


def test_rows_survive(spark, sf, built):
    root, _ = built
    back = layers.scan_all(spark, f"{root}/units-1/units")
    source = features(spark, sf)
    assert back.count() == source.count()
    columns = ["fid", "part_key", "huc12", "area_km2", "bbox"]
    assert back.select(columns).exceptAll(source.select(columns)).isEmpty()
    assert {r.part_key for r in back.select("part_key").distinct().collect()} >= {"00", "01"}
    assert not list(Path(root).glob(".units*")) and not list(Path(root).glob("**/_written"))


def test_groups_are_as_planned(built):
    root, done = built
    found = 0
    groups = {}
    for g in done.groups.collect():
        groups.setdefault(g.path, []).append(g)
    several = 0
    for path, planned in groups.items():
        file = pq.ParquetFile(f"{root}/units-1/units/{path}")
        found += file.metadata.num_rows
        assert file.metadata.num_row_groups == len(planned)
        for g in planned:
            assert file.metadata.row_group(g.group_no).num_rows == g.rows
        geo = json.loads(file.metadata.metadata[b"geo"])
        assert geo["columns"]["geometry"]["covering"]["bbox"]["ymax"] == ["bbox", "ymax"]
        assert geo["columns"]["geometry"]["geometry_types"] == ["Polygon"]
        assert file.metadata.row_group(0).column(0).compression == "ZSTD"
        several += not path.endswith("/data.parquet")
    assert found == 1500 and several > 0


def test_documents(spark, built):
    root, done = built
    dataset = f"{root}/units-1"
    items = catalog.scan_items(spark, dataset)
    assert items.count() == 25
    facts = {r.value: r for r in done.facts.collect()}
    for r in items.collect():
        assert r.rows == facts[r.value].rows and r.title.startswith("Units: Region")
    agree = checks.item_version_agree(catalog.item_assets(items), catalog.scan_versions(spark, dataset))
    assert agree.where("not agrees").isEmpty() and agree.count() == done.files.count()
    assert [r.schemas for r in checks.schema_agree(items).collect()] == [1]
    (collection,) = catalog.scan_collections(spark, dataset).collect()
    assert (collection.rows, collection.files) == (1500, done.files.count())
    assert [r.name for r in catalog.scan_catalogs(spark, str(root)).collect()] == ["units-1"]
    doc = json.loads(Path(f"{dataset}/units/collection.json").read_text())
    assert doc["extent"]["temporal"]["interval"] == [["2026-01-01T00:00:00Z", None]]
    assert doc["table:columns"][-1]["name"] in ("bbox", "part_key") and doc["partition:glob"] == "./part_key=*/*.parquet"
    assert [link["rel"] for link in doc["links"]][:3] == ["root", "parent", "item"]
    manifest = json.loads(Path(f"{dataset}/manifest.json").read_text())
    assert manifest["totals"]["parquet_files"] == done.files.count()
    assert json.loads(Path(f"{root}/catalog.json").read_text())["links"][1]["href"] == "./units-1/catalog.json"


def test_manifest_matches_listing(spark, built, tmp_path):
    root, _ = built
    manifest = catalog.scan_manifests(spark, str(root)).where("dataset = 'units-1'")
    listing = inventory.file_inventory(spark, f"{root}/units-1", exclude=("manifest.json",))
    assert checks.manifest_vs_listing(manifest, listing).isEmpty()
    broken = listing.where("path != 'catalog.json'").withColumn(
        "sha256", F.when(F.col("path").endswith("collection.json"), "00").otherwise(F.col("sha256"))
    )
    problems = {(r.path, r.problem) for r in checks.manifest_vs_listing(manifest, broken).collect()}
    assert problems == {("catalog.json", "missing"), ("units/collection.json", "sha256 differs")}


def test_probe_covers_matches(spark, built):
    root, done = built
    area = (-100.0, 30.0, -80.0, 40.0)
    groups = footers.scan_footers(spark, f"{root}/units-1/units")
    report = {r.path: r for r in pruning.probe(groups, area).collect()}
    assert len(report) == done.files.count()
    selected = {}
    for r in pruning.probe_runs(groups, area).collect():
        selected.setdefault(r.path, []).extend(range(r.first_group, r.first_group + r.groups))
    back = layers.scan_all(spark, f"{root}/units-1/units").where(boxes.intersects(area))
    hits = {}
    for r in back.select("fid", F.col("_metadata.file_path").alias("f")).collect():
        hits.setdefault("/".join(r.f.split("/")[-2:]), set()).add(r.fid)
    for path, fids in hits.items():
        file = pq.ParquetFile(f"{root}/units-1/units/{path}")
        seen = set()
        for g in selected[path]:
            seen |= set(file.read_row_group(g, columns=["fid"]).column(0).to_pylist())
        assert fids <= seen
        assert report[path].selected_rows == len(seen)
    plan = formatted(back)
    assert "GreaterThanOrEqual(bbox.xmax,-100.0)" in plan


def test_immutable(spark, built):
    root, _ = built
    with pytest.raises(FileExistsError):
        build.build_dataset(spark, "units", [], f"{root}/units-1", "x", "x", "x")


def test_refusals(spark, sf, tmp_path):
    rows = shaped_features(spark, sf)
    layer = feature_layer(rows.withColumn("part_key", F.when(F.col("fid") != 7, F.col("part_key"))))
    with pytest.raises(checks.CheckFailed, match="belong to no partition"):
        build.write_layer(layer, str(tmp_path / "a"), LayoutOptions())
    with pytest.raises(ValueError, match="unknown part_key"):
        build.write_layer(feature_layer(rows), str(tmp_path / "b"), LayoutOptions(), only=["00", "zz"])
    with pytest.raises(checks.CheckFailed, match="layer is empty"):
        build.write_layer(feature_layer(rows.where("fid < 0")), str(tmp_path / "d"), LayoutOptions())
    with pytest.raises(ValueError, match="capped"):
        LayoutOptions(group_rows=150_001)
    coded = build.Layer(rows, feature_layer(rows).spec, "part_key", ("fid",), codes.with_region_label, code="huc12", digits=11)
    with pytest.raises(checks.CheckFailed, match="malformed huc12"):
        build.write_layer(coded, str(tmp_path / "c"), LayoutOptions())


def test_watershed_layer(spark, sf, tmp_path):
    rows = shaped_features(spark, sf).select(
        F.col("fid").alias("objectid"), F.concat(F.lit("T"), "fid").alias("tnmid"), "huc12", "area_km2",
        F.col("geometry").alias("shape"),
    )
    layer = build.watershed_units(rows, 12, "2026-09-02", "2026-09-02T00:00:00Z")
    out = build.write_layer(layer, str(tmp_path / "hu12"), LayoutOptions(group_bytes=BUDGET), only=["01", "16"], boxless_groups=True)
    labels = {r.value: r.label for r in out.facts.collect()}
    assert labels == {"01": "Region 01 New England", "16": "Region 16 Great Basin"}
    back = layers.scan_all(spark, str(tmp_path / "hu12"), committed=False)
    assert back.columns == ["tnmid", "huc12", "area_km2", "geometry", "bbox", "huc2"]
    one = back.select("huc12").where("huc2 = '16'").orderBy("huc12").first().huc12
    found = layers.code_lookup(back, "huc2", "huc12", one)
    assert found.count() == 1
    plan = formatted(found)
    assert "PartitionFilters: [isnotnull(huc2" in plan


def test_failed_build_leaves_nothing(spark, sf, tmp_path):
    rows = shaped_features(spark, sf).withColumn("part_key", F.lit("a/b"))
    with pytest.raises(checks.CheckFailed, match="cannot name a folder"):
        build.build_dataset(spark, "units", [feature_layer(rows)], str(tmp_path / "out"), "x", "x", "x")
    assert list(tmp_path.iterdir()) == []


def test_places_files_without_moving_them(spark, sf, tmp_path, monkeypatch):
    """On stores without a rename: files stay where they were written, and strays are deleted."""
    monkeypatch.setattr(files, "renames_at_once", lambda *_: False)
    stray = tmp_path / "out" / "units" / "part_key=03" / "data-stray.parquet"
    rows = shaped_features(spark, sf)
    real = build.writer._keep_reported

    def with_stray(written, target):
        stray.write_bytes(b"left by a task that was lost")
        return real(written, target)

    monkeypatch.setattr(build.writer, "_keep_reported", with_stray)
    done = build.build_dataset(
        spark, "units", [feature_layer(rows)], str(tmp_path / "out"), "x", "x", "x", LayoutOptions(group_bytes=BUDGET), boxless_groups=True
    )["units"]
    there = {str(p.relative_to(tmp_path / "out" / "units")) for p in (tmp_path / "out").rglob("*.parquet")}
    assert there == {r.path for r in done.files.select("path").collect()} and len(there) == 25
    assert layers.scan_all(spark, str(tmp_path / "out" / "units")).count() == 1500
    assert json.loads((tmp_path / "out" / "manifest.json").read_text())["totals"]["parquet_files"] == 25


def test_partition_without_a_box(spark, sf, tmp_path):
    rows = shaped_features(spark, sf).withColumn("part_key", F.when(F.col("geometry").isNull(), "none").otherwise("some"))
    build.build_dataset(spark, "units", [feature_layer(rows)], str(tmp_path / "out"), "x", "x", "x", boxless_groups=True)
    none, some = (json.loads((tmp_path / "out" / "units" / f"part_key={v}" / f"part_key={v}.json").read_text()) for v in ("none", "some"))
    assert none["geometry"] is None and "bbox" not in none
    assert some["geometry"]["type"] == "Polygon" and len(some["bbox"]) == 4
    geo = json.loads(pq.ParquetFile(tmp_path / "out" / "units" / "part_key=none" / "data.parquet").metadata.metadata[b"geo"])
    assert "bbox" not in geo["columns"]["geometry"]
    parts = json.loads((tmp_path / "out" / "manifest.json").read_text())["collections"]["units"]
    assert ["bbox" in p for p in parts] == [False, True] and all(len(p["sha256"]) == 64 for p in parts)


def test_wanted_values_over_layers(spark, sf, tmp_path):
    rows = shaped_features(spark, sf)
    one = feature_layer(rows)
    spec = CollectionSpec(**{**vars(one.spec), "id": "few"})
    few = build.Layer(rows.where("part_key < '05'"), spec, "part_key", ("fid",), codes.with_region_label)
    with pytest.raises(ValueError, match="unknown partition values: ..zz"):
        build.build_dataset(spark, "units", [one, few], str(tmp_path / "a"), "x", "x", "x", only=["07", "zz"])
    assert list(tmp_path.iterdir()) == []
    done = build.build_dataset(spark, "units", [one, few], str(tmp_path / "b"), "x", "x", "x", only=["07"], boxless_groups=True)
    assert list(done) == ["units"] and not (tmp_path / "b" / "few").exists()
    assert json.loads((tmp_path / "b" / "manifest.json").read_text())["parameters"]["skipped"] == ["few"]


def test_documents_are_streamed_by_many_tasks(spark, tmp_path):
    """Documents of many pieces, dealt out by path; a list's entries in order, with commas between them."""
    pieces = spark.range(3000).selectExpr(
        "concat('d', id % 40, '.json') as path", "1 as section", "lpad(cast(id as string), 5, '0') as name", "cast(id as string) as text"
    )
    ends = spark.range(40).selectExpr("concat('d', id, '.json') as path", "explode(array(0, 2)) as section", "'' as name").selectExpr("*", "if(section = 0, '[', ']') as text")
    out = files.write_documents(pieces.unionByName(ends), str(tmp_path))
    assert "collect_list" not in formatted(out)
    done = {r.path: r.bytes for r in out.collect()}
    assert out.withColumn("task", F.spark_partition_id()).select("task").distinct().count() > 1
    for k in range(40):
        text = (tmp_path / f"d{k}.json").read_text()
        assert json.loads(text) == list(range(k, 3000, 40)) and len(text) == done[f"d{k}.json"]


def test_published_layers_say_their_terms(spark, sf):
    rows = shaped_features(spark, sf).select(F.col("fid").alias("objectid"), F.concat(F.lit("T"), "fid").alias("tnmid"), F.col("huc12").alias("huc14"), F.col("geometry").alias("shape"))
    layer = build.watershed_units(rows, 14, "2026-09-02", "2026-09-02T00:00:00Z")
    assert "part of the country" in layer.spec.description and layer.spec.via.startswith("https://www.usgs.gov/") and layer.spec.license_url
    assert build.written_columns(layer).columns == ["tnmid", "huc14", "geometry", "bbox"]
    areas = build.protected_areas(rows.select(F.col("objectid").alias("OBJECTID"), F.lit("UT").alias("State_Nm"), F.col("shape").alias("SHAPE")))
    assert build.written_columns(areas).columns == ["OBJECTID", "State_Nm", "SHAPE", "bbox"] and areas.spec.via


def test_reads_what_was_committed(spark, built, tmp_path):
    """Files that are in a partition's folder but not in the manifest are not read; a folder without a manifest is refused."""
    root, done = built
    shutil.copytree(f"{root}/units-1", tmp_path / "units-1")
    folder = tmp_path / "units-1" / "units"
    late = folder / done.files.first().path
    shutil.copy(late, late.with_name("data-late.parquet"))
    (folder / "part_key=new").mkdir()
    shutil.copy(late, folder / "part_key=new" / "data.parquet")
    back = layers.scan_all(spark, str(folder))
    assert back.count() == 1500 and layers.scan_all(spark, str(folder), committed=False).count() > 1500
    assert back.where("part_key = '07'").count() == layers.scan_partition(spark, str(folder), "part_key", "07", ["fid"]).count() > 0
    (tmp_path / "units-1" / "manifest.json").unlink()
    with pytest.raises(ValueError, match="no build was committed"):
        layers.scan_all(spark, str(folder))


def test_shapes_move_once(spark, sf):
    """No shuffle between the source's scan and the one to the files' tasks, and the files are the planned ones."""
    rows = shaped_features(spark, sf).select("fid", "part_key", "geometry")
    options = LayoutOptions(group_bytes=BUDGET, file_bytes=5_000)
    measures = layout.measure(rows, "part_key", ["fid"], "geometry")
    extent = layout.measured_extent(measures, "part_key")
    placed, chosen = layout.layout_search(layout.costed_rows(measures, extent, "part_key"), "part_key", ["fid"], options)
    dealt = build.writer._dealt_to_files(rows, placed, extent.join(chosen, "part_key"), "part_key", ["fid"], "geometry")
    plan = formatted(dealt).split("Subqueries")[0]
    lines = [line for line in plan.split("(1) ")[0].splitlines() if re.search(r"Exchange|SortMergeJoin", line)]
    assert all("BroadcastExchange" in line for line in lines), lines
    got = {r.fid: r._file_no for r in dealt.select("fid", "_file_no").collect()}
    assert got == {r.fid: r.file_no for r in placed.collect()} and len(set(got.values())) > 1


def test_writer_gives_memory_back(tmp_path):
    """What the footer of a file of many groups takes is not kept by the worker that wrote it."""
    code = """
import json, resource, sys
import numpy as np, pyarrow as pa
from landstrata.sources import writer
def resident():
    return int(open("/proc/self/statm").read().split()[1]) * resource.getpagesize() / 1e6
def batches(n):
    about = json.dumps({"geometry_types": ["Polygon"], "xmin": None, "budget": 1})
    for k in range(n // 1000):
        box = pa.StructArray.from_arrays([pa.array(np.random.rand(1000))] * 4, ["xmin", "ymin", "xmax", "ymax"])
        columns = {"id": pa.array(np.arange(1000)), "geometry": pa.array([b"x"] * 1000, pa.binary()), "bbox": box, "_part": ["a"] * 1000, "_file_no": pa.array([0] * 1000),
            "_large": pa.array([False] * 1000), "_boxless": pa.array([False] * 1000), "_curve": pa.array([0] * 1000), "_cost": pa.array([1] * 1000),
            "_facts": pa.array([about if k == 0 else None] + [None] * 999, pa.string())}
        yield pa.RecordBatch.from_pydict(columns)
write = lambda n: sum(b.num_rows for b in writer._write_files(batches(n), sys.argv[1], "geometry", None, 1, 1000, None))
assert write(1000) == 1000
before = resident()
assert write(6000) == 6000
print(resident() - before)
"""
    root = Path(__file__).resolve().parents[1]
    done = subprocess.run([sys.executable, "-c", code, str(tmp_path)], cwd=root, capture_output=True, text=True, check=True)
    assert float(done.stdout) < 30, done.stdout
