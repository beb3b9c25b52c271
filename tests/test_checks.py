import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from landstrata.operators import aggregates, checks, layout, ordering, pruning, readers
from landstrata.session import small_side
from landstrata.sources import files, inventory, layers


def test_tree_digest_sorts_by_path_parts(spark, tmp_path):
    for name, body in (("a/b", b"1"), ("a-b", b"22"), ("a/c/d", b""), (".hidden", b"x"), ("_under", b"u"), ("z", b"3" * 9_000_000)):
        path = tmp_path / "tree" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(body)
    found = inventory.file_inventory(spark, str(tmp_path / "tree"))
    sizes = {r.path: (r.bytes, r.sha256) for r in found.collect()}
    assert sizes["z"] == (9_000_000, hashlib.sha256(b"3" * 9_000_000).hexdigest()) and ".hidden" in sizes
    lines = [f"{n}\t{sizes[n][1]}\n" for n in ("_under", "a/b", "a/c/d", "a-b", "z")]
    (row,) = inventory.tree_digest(found).collect()
    assert (row.files, row.bytes) == (5, 9_000_004)
    assert row.sha256 == hashlib.sha256("".join(lines).encode()).hexdigest()
    named = inventory.file_inventory(spark, str(tmp_path / "tree"), exclude=("z",))
    assert "z" not in {r.path for r in named.collect()}


def test_tree_diff(spark):
    schema = "path string, bytes bigint, sha256 string"
    ours = spark.createDataFrame([("a", 1, "x"), ("b", 1, "x"), ("c/skip/d", 1, "x"), ("e.parquet", 1, "x"), ("f", 1, "x")], schema)
    theirs = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y"), ("g", 1, "x"), ("f", 2, "x")], schema)
    found = checks.tree_diff(ours, theirs, ("skip",), (".parquet",)).collect()
    assert {(r.path, r.difference) for r in found} == {("b", "differ"), ("f", "differ"), ("g", "only theirs")}


def test_manifest_compares_small_files_by_content(spark):
    schema = "path string, bytes bigint, sha256 string"
    manifest = spark.createDataFrame([("big", 6_000_000, "x"), ("small", 10, "x"), ("gone", 1, "x"), ("short", 9, "x"), ("same", 1, "x")], schema)
    live = spark.createDataFrame([("big", 6_000_000, "y"), ("small", 10, "y"), ("short", 8, "x"), ("same", 1, "x"), ("more", 1, "x")], schema)
    found = {(r.path, r.problem) for r in checks.manifest_vs_listing(manifest, live, 5_000_000).collect()}
    assert found == {("small", "sha256 differs"), ("gone", "missing"), ("short", "bytes differ")}
    whole = {(r.path, r.problem) for r in checks.manifest_vs_listing(manifest, live).collect()}
    assert whole == found | {("big", "sha256 differs")}


def test_source_pin(spark):
    schema = "name string, files bigint, bytes bigint, sha256 string"
    found = spark.createDataFrame([("a", 1, 2, "x"), ("b", 1, 2, "y")], schema)
    pins = spark.createDataFrame([("a", 1, 2, "x"), ("b", 1, 2, "x"), ("c", 1, 2, "x")], schema)
    strict = {r.name: (r.matches, r.accepted) for r in checks.source_pin(found, pins, "name").collect()}
    assert strict == {"a": (True, True), "b": (False, False), "c": (False, False)}
    assert checks.source_pin(found, pins, "name", allow_unpinned=True).where("not accepted").isEmpty()


def test_key_audit_counts_missing_codes_as_duplicates(spark):
    df = spark.createDataFrame([("01",), ("01",), (None,), (None,), ("1",), ("02\n",)], "code string")
    assert tuple(aggregates.key_audit(df, "code", 2).first()) == (6, 4, 3)


def boxes_in_a_row(spark, boxes):
    rows = [("k", i, *map(float, b)) for i, b in enumerate(boxes)]
    return spark.createDataFrame(rows, "k string, seq bigint, xmin double, ymin double, xmax double, ymax double")


@pytest.mark.parametrize(
    "boxes, passes, overlapping",
    [
        # Touching boxes do not overlap.
        ([(0, 0, 1, 1), (1, 0, 2, 1), (2, 0, 3, 1), (3, 0, 4, 1), (4, 0, 5, 1)], True, 0),
        # Everything on everything.
        ([(0, 0, 1, 1)] * 5, False, 4),
        # No area at all.
        ([(0, 0, 0, 1)] * 5, True, 0),
        # Three of ten pairs overlap: 0.3 is not below 0.3, and the boxes are large.
        ([(0, 0, 9, 18)] * 4 + [(9, 0, 18, 18), (0, 0, 9, 18)] * 3 + [(9, 0, 18, 18)], False, 3),
        # Overlap throughout, but the boxes are small against the whole.
        ([(i, 0, i + 1.5, 1) for i in range(20)], True, 19),
    ],
)
def test_order_test(spark, boxes, passes, overlapping):
    (row,) = layout.order_test(boxes_in_a_row(spark, boxes), ["k"]).collect()
    assert row.overlapping == overlapping
    assert row.passes == passes


@pytest.mark.parametrize("rows, tested", [(199, False), (200, True), (201, True)])
def test_row_level_needs_200_rows(spark, rows, tested):
    df = spark.range(rows + 3).selectExpr(
        "'k' as k", "id as position", "false as is_large", f"{rows + 3}L as rows", "3L as empty_geometries",
        f"if(id < {rows}, named_struct('xmin', id * 1d, 'ymin', 0d, 'xmax', id + 1d, 'ymax', 1d), named_struct('xmin', cast(null as double), 'ymin', cast(null as double), 'xmax', cast(null as double), 'ymax', cast(null as double))) as bbox",
    )
    chunks = layout.chunk_boxes(df, ["k"]).count()
    step = -(-rows // 10)
    assert chunks == (-(-rows // step) if tested else 0)


@pytest.mark.parametrize("groups, tested", [(4, 0), (5, 5)])
def test_group_level_needs_five_groups(spark, groups, tested):
    rows = [("k", i, False, 0.0, 0.0, 1.0, 1.0) for i in range(groups - 1)] + [("k", groups - 1, False, None, None, None, None), ("k", groups, True, 0.0, 0.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "k string, group_id bigint, is_large boolean, xmin double, ymin double, xmax double, ymax double")
    found = sorted(r.seq for r in layout.group_boxes(df, ["k"]).collect())
    assert found == list(range(tested))


def test_positions_over_many_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(5000).selectExpr("id", "if(id % 3 = 0, 'hot', concat('k', id % 40)) as k", "id * 7919 % 5000 as v")
        got = ordering.with_position(df, ["k"], [F.col("k"), F.col("v"), F.col("id")]).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    keys = {}
    for r in sorted(got, key=lambda r: (r.k, r.v, r.id)):
        assert r.position == keys.setdefault(r.k, 0)
        keys[r.k] += 1
    assert len(got) == 5000


def test_summary_too_large_to_broadcast(spark):
    side, fits = small_side(spark.range(100), limit=50)
    assert not fits
    ordered = ordering.in_order(spark.range(2000).selectExpr("id", "id % 100 as k"), [F.col("k"), F.col("id")])
    from landstrata import session

    keep, session.small_side.__defaults__ = session.small_side.__defaults__, (10,)
    try:
        joined = ordering.attach(ordered, side.withColumnRenamed("id", "k"), ["k"])
        plan = spark._jvm.PythonSQLUtils.explainString(joined._jdf.queryExecution(), "simple")
        per_task = joined.select("row_at").rdd.mapPartitions(lambda rows: [[r.row_at for r in rows]]).collect()
    finally:
        session.small_side.__defaults__ = keep
    assert "Exchange hashpartitioning(shiftright" in plan
    assert sum(map(len, per_task)) == 2000 and all(p == sorted(p) for p in per_task)


def test_probe_keeps_files_without_a_hit(spark):
    rows = [("a", 0, 5, 10, 20, 0.0, 0.0, 1.0, 1.0), ("a", 1, 5, 10, 20, 5.0, 5.0, 6.0, 6.0), ("b", 0, 5, 10, 20, 9.0, 9.0, 9.5, 9.5), ("a", 2, 1, 1, 2, None, None, None, None)]
    df = spark.createDataFrame(rows, "path string, group_no int, rows bigint, compressed_bytes bigint, uncompressed_bytes bigint, xmin double, ymin double, xmax double, ymax double")
    found = {r.path: r for r in pruning.probe(df, (1.0, 1.0, 5.0, 5.0)).collect()}
    assert found["a"].selected_groups == 2 and found["a"].selected_rows == 10 and found["a"].row_groups == 3
    runs = [tuple(r) for r in pruning.probe_runs(df, (1.0, 1.0, 5.0, 5.0)).collect()]
    assert runs == [("a", 0, 2)]
    assert found["b"].selected_groups == 0 and found["b"].selected_compressed_bytes == 0


def test_probe_lists_the_groups_it_selects(spark):
    """The numbers themselves, in their order and not that of their texts; groups without a box are none of them."""
    rows = [("a", k, 1, 1, 1, float(k), 0.0, float(k), 0.0) for k in (11, 2, 10, 3, 30)] + [("a", 4, 1, 1, 1, None, None, None, None), ("b", 0, 1, 1, 1, 50.0, 0.0, 50.0, 0.0)]
    df = spark.createDataFrame(rows, "path string, group_no int, rows bigint, compressed_bytes bigint, uncompressed_bytes bigint, xmin double, ymin double, xmax double, ymax double")
    found = {r.path: r.selected_row_groups for r in pruning.probe(df, (2.0, 0.0, 20.0, 1.0)).collect()}
    assert found == {"a": [2, 3, 10, 11], "b": []}


@pytest.mark.parametrize("name", ["probe", "probe_footers"])
def test_probe_queries_name_their_groups(spark, sf, name):
    rows = entry.queries()[name](spark, sf).collect()
    assert all(r.selected == ",".join(sorted(filter(None, r.selected.split(",")), key=int)) for r in rows)
    assert sum(r.selected_groups for r in rows) > 0 and all(len(list(filter(None, r.selected.split(",")))) == r.selected_groups for r in rows)


def test_acres_are_counted_once_per_place(spark):
    rows = [("UT", "p", "Fee", 2, 10.0), ("UT", "p", "Easement", 1, 7.0), ("UT", "q", "Fee", 3, 5.0), ("NV", "r", "Fee", 4, 1.5)]
    df = spark.createDataFrame(rows, "state string, place string, category string, id int, acres double")
    once = {r.state: (r.places, r.acres) for r in readers.acres_dedup(df, ["state", "place"], ["category", "id"], "acres", "state").collect()}
    assert once == {"UT": (2, 12.0), "NV": (1, 1.5)}
    fee = {r.state: r.acres for r in readers.acres_of_category(df, "category", "Fee", "acres", "state").collect()}
    assert fee == {"UT": 15.0, "NV": 1.5}


def test_key_stays_text(spark, tmp_path):
    target = str(tmp_path / "t")
    spark.createDataFrame([("01", 1), ("16", 2)], "huc2 string, v int").write.partitionBy("huc2").parquet(target)
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "true")
    try:
        back = layers.scan_all(spark, target, committed=False)
        assert sorted(r.huc2 for r in back.collect()) == ["01", "16"]
        assert spark.conf.get("spark.sql.sources.partitionColumnTypeInference.enabled") == "true"
    finally:
        spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")


def test_null_key_guard(spark):
    df = spark.createDataFrame([("a",), (None,)], "k string")
    with pytest.raises(checks.CheckFailed):
        checks.not_null_key_guard(df, "k")
    assert checks.not_null_key_guard(df.dropna(), "k").count() == 1


def test_paths():
    for uri in ("/a/b", "file:/a/b", "file:///a/b"):
        assert files.filesystem(uri)[1] == "/a/b"


def test_unsafe_keys(spark):
    values = ["UT", "a b", "a/b", "", "a=b", "a%b", "a]b", "a\\b", "a\nb", "a-b_c.d"]
    df = spark.createDataFrame([(v,) for v in values], "k string")
    assert {r.k for r in checks.unsafe_keys(df, "k").collect()} == set(values) - {"UT", "a b", "a-b_c.d"}


def test_runs_over_stretches(spark, monkeypatch):
    """Runs of any length, over borders of stretches, equal those of one walk."""
    monkeypatch.setattr(pruning, "STRETCH", 8)
    rng = np.random.default_rng(4)
    rows, want = [], set()
    for file, share in (("a", 0.9), ("b", 0.5), ("c", 0.05), ("d", 1.0)):
        hit = rng.random(100) < share
        rows += [(file, k, 0.0, 0.0, 1.0, 1.0) if h else (file, k, 5.0, 5.0, 6.0, 6.0) for k, h in enumerate(hit)]
        edges = np.flatnonzero(np.diff(np.concatenate([[0], hit, [0]])))
        want |= {(file, int(a), int(b - a)) for a, b in zip(edges[::2], edges[1::2])}
    df = spark.createDataFrame(rows, "path string, group_no int, xmin double, ymin double, xmax double, ymax double")
    got = [tuple(r) for r in pruning.probe_runs(df, (0.0, 0.0, 2.0, 2.0)).collect()]
    assert len(got) == len(want) and set(got) == want


@pytest.mark.parametrize("n", [10, 10_000])
def test_items_prune_partitions_at_run_time(spark, tmp_path, n):
    """One plan without a job of its own; files of other partitions are not read."""
    items = spark.range(n).selectExpr("lpad(cast(id as string), 5, '0') as value", "double(id) as xmin", "0e0 as ymin", "double(id) + 0.5 as xmax", "1e0 as ymax")
    items.write.parquet(str(tmp_path / "items"))
    rows = spark.range(40).selectExpr("lpad(cast(id % 20 as string), 5, '0') as k", "id", "named_struct('xmin', double(id % 20), 'ymin', 0e0, 'xmax', double(id % 20), 'ymax', 0e0) as bbox")
    rows.write.partitionBy("k").parquet(str(tmp_path / "layer"))
    layer = layers.scan_all(spark, str(tmp_path / "layer"), committed=False)
    found = pruning.item_pruned(layer, spark.read.parquet(str(tmp_path / "items")), "k", (3.0, 0.0, 4.2, 1.0))
    plan = spark._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "formatted")
    assert "dynamicpruning" in plan
    assert sorted((r.k, r.id) for r in found.collect()) == [("00003", 3), ("00003", 23), ("00004", 4), ("00004", 24)]


def test_half_of_all_units_drain_to_one(spark, monkeypatch):
    """No task reads more than twice the median of the salted join's left side, and rows are those of a plain join."""
    rows = [(f"u{k}", "u1" if k % 2 else f"u{k // 2}" if k % 3 else None, float(k)) for k in range(8000)]
    units = spark.createDataFrame(rows, "code string, to string, area double")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = readers.downstream_unit(units, "code", "to", ["area"], 8)
        sizes = sorted(r["count"] for r in joined.where("to is not null").groupBy(F.spark_partition_id()).count().collect())
        got = {(r.code, r.to, r.downstream_found, r.downstream_area) for r in joined.collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    area = {c: a for c, _, a in rows}
    assert got == {(c, t, t in area, area.get(t)) for c, t, _ in rows} and joined.count() == len(rows)
    assert sizes[-1] <= 2 * sizes[len(sizes) // 2]
