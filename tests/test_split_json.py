import json
import random

import pytest

from landstrata.sources import catalog, split_json

ODD = ["plain", "a,b", 'quote"d', "back\\slash", 'both\\",', "{brace", "]}bracket,", ",,", "\\", "line\nbreak", "é日😀", "", ":", '":{"']


@pytest.fixture
def small_splits(spark):
    """Byte ranges of a few hundred bytes, so that entries lie over their borders."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def names(rng, n):
    return {f"{rng.choice(ODD)}/{k}{rng.choice(ODD)}": k for k in range(n)}


def manifest(rng, n):
    files = {name: {"bytes": k, "sha256": f"s,{k}}}"} for name, k in names(rng, n).items()}
    around = {"kind": "x,{", "sources": [{"files": {"not this": {"bytes": 1}}}, []], "parameters": {"a": [1, [2, {"files": 3}]], "s": '}"{'}}
    parts = {"units": [{"value": f"{k},", "bbox": [1, 2]} for k in range(30)], "none": []}
    return around | {"collections": parts, "files": files, "totals": {"parquet_files": 1}}, files


@pytest.mark.parametrize("indent", [None, 2])
def test_manifests(spark, tmp_path, small_splits, indent):
    rng = random.Random(1)
    want = set()
    for dataset, n in (("one", 150), ("two", 3), ("empty", 0)):
        (tmp_path / dataset).mkdir()
        doc, files = manifest(rng, n)
        (tmp_path / dataset / "manifest.json").write_text(json.dumps(doc, indent=indent, ensure_ascii=bool(indent)))
        want |= {(dataset, path, f["bytes"], f["sha256"]) for path, f in files.items()}
    rows = catalog.scan_manifests(spark, str(tmp_path))
    got = [tuple(r) for r in rows.collect()]
    assert len(got) == len(want) and set(got) == want
    assert spark.read.text(f"{tmp_path}/one/manifest.json", lineSep=",").rdd.getNumPartitions() > 20


def test_versions(spark, tmp_path, small_splits):
    rng = random.Random(2)
    want = set()
    for collection in ("a", "b"):
        (tmp_path / collection).mkdir()
        versions = []
        for number, n in (("1.0.0", 40), ("1.1.0, second", 0), ("2.0.0", 25)):
            assets = {p: {"sha256": f"{k}", "size_bytes": k, "href": p} for p, k in names(rng, n).items()}
            want |= {(collection, number, p, v["sha256"], v["size_bytes"], p) for p, v in assets.items()}
            inner = {"version": number, "created": "x", "breaking": False, "message": 'assets: {",', "assets": assets, "changes": list(assets)}
            versions.append(dict(sorted(inner.items(), key=lambda x: x[0] == "version")) if n == 25 else inner)  # its name last
        (tmp_path / collection / "versions.json").write_text(json.dumps({"spec_version": "1", "versions": versions, "current_version": "2.0.0"}))
    got = [tuple(r) for r in catalog.scan_versions(spark, str(tmp_path)).collect()]
    assert len(got) == len(want) and set(got) == want


def test_states_of_pieces(spark, tmp_path, small_splits):
    """Against a walk over the characters."""
    rng = random.Random(3)
    text = json.dumps(manifest(rng, 60)[0])
    (tmp_path / "doc.json").write_text(text)
    got = [(r.text, r.inside, r.depth) for r in split_json.pieces(spark, f"{tmp_path}/doc.json").orderBy("block", "n").collect()]
    want, inside, depth, began, skip = [], False, 0, (0, False, 0), False
    for k, c in enumerate(text):
        if skip:
            skip = False
        elif inside and c == "\\":
            skip = True
        elif c == '"':
            inside = not inside
        elif not inside and c in "[]{}":
            depth += 1 if c in "[{" else -1
        if c == ",":
            want.append((text[began[0] : k], *began[1:]))
            began = (k + 1, inside, depth)
    want.append((text[began[0] :], *began[1:]))
    assert got == want


def test_a_long_manifest(spark, tmp_path):
    """One line of 30 MB, read by several tasks."""
    (tmp_path / "d").mkdir()
    n = 300_000
    with open(tmp_path / "d" / "manifest.json", "w") as out:
        out.write('{"kind":"x","files":{')
        out.writelines(("," if k else "") + f'"p{k:07d},x":{{"bytes":{k},"sha256":"{k:040x}"}}' for k in range(n))
        out.write('},"totals":{}}')
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")
    try:
        rows = catalog.scan_manifest(spark, f"{tmp_path}/d")
        r = rows.selectExpr("count(*) as n", "sum(bytes) as bytes", "count(distinct path) as paths", "max(path) as last").first()
        tasks = spark.read.text(f"{tmp_path}/d/manifest.json", lineSep=",").rdd.getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert (r.n, r.bytes, r.paths, r.last) == (n, n * (n - 1) // 2, n, "p0299999,x") and tasks > 5
