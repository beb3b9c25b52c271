import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from landstrata.functions import boxes
from landstrata.operators import cuts, layout, ordering
from landstrata.plans.features import features

import slow


@pytest.fixture
def many_tasks(spark):
    """Keeps small tables on many tasks, so that partitions span several of them."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def run_cut(spark, rows, budget, max_rows, file_cost=10**9):
    df = spark.createDataFrame(rows, "k string, n bigint, cost bigint, is_large boolean").withColumn(
        "budget", F.lit(budget).cast("bigint")
    )
    ordered = ordering.in_order(df, [F.col("k"), F.col("is_large"), F.col("n")])
    out = cuts.cut_groups(ordered, ["k"], max_rows, file_cost).collect()
    got = {}
    for r in sorted(out, key=lambda r: (r.k, r.position)):
        got.setdefault(r.k, []).append(r)
    return got


@pytest.mark.parametrize("seed, fan", [(0, 64), (1, 2), (2, 3), (3, 64), (4, 2), (5, 4)])
def test_cut_equals_row_by_row(spark, many_tasks, monkeypatch, seed, fan):
    monkeypatch.setattr(cuts, "FAN", fan)
    rng = random.Random(seed)
    budget, max_rows = rng.choice([(100, 7), (50, 1000), (37, 5), (1000, 1000), (10, 3), (64, 64)])
    rows = []
    for key, n in (("hot", 900), ("b", 30), ("c", 1), ("d", 120)):
        large_from = rng.choice([n, n // 2, n - 3, 0])
        shape = rng.choice(["mixed", "even", "zero"])
        for i in range(n):
            cost = {"mixed": rng.choice([0, 1, 5, 20, 90, 150]), "even": 7, "zero": 0}[shape]
            rows.append((key, i, cost, i >= large_from))
    got = run_cut(spark, rows, budget, max_rows, file_cost=500)
    for key in got:
        mine = [r for r in rows if r[0] == key]
        want = slow.cut([r[2] for r in mine], [r[3] for r in mine], budget, max_rows)
        assert [r.group_id for r in got[key]] == want
        assert not slow.cut_faults([r[2] for r in mine], [r[3] for r in mine], budget, max_rows, want)
        assert [r.position for r in got[key]] == list(range(len(mine)))
        # a file takes whole groups, by the cost before the group
        before, files, heads = 0, {}, []
        for row, group in zip(mine, want):
            if group not in files:
                files[group] = before // 500
                heads.append(True)
            else:
                heads.append(False)
            before += row[2]
        assert [r.file_no for r in got[key]] == [files[g] for g in want]
        assert [r.group_head for r in got[key]] == heads


def test_cut_passes_over_blocks():
    """Pass 1 fed in blocks of any size records what a row-by-row cut from each start would leave."""
    rng = np.random.default_rng(5)
    for trial in range(60):
        n = int(rng.integers(1, 60))
        costs = rng.choice([0, 1, 4, 9, 30], n).astype(np.int64)
        large = np.arange(n) >= rng.choice([n, n // 2, 0])
        budget, max_rows, block = int(rng.integers(1, 40)), int(rng.integers(1, 9)), int(rng.integers(1, 11))
        look = cuts._Outlook(False)
        for a in range(0, n, block):
            look.add(costs[a : a + block], large[a : a + block], budget, max_rows)
        for i, start in enumerate(look.starts):
            groups = slow.cut(costs[start:], large[start:], budget, max_rows)
            assert look.begun[i] == groups[-1] + 1
            last = [c for c, g in zip(costs[start:], groups) if g == groups[-1]]
            assert (look.spent[i], look.held[i]) == (sum(last), len(last))


def composed_states(costs, large, edges, budget, max_rows):
    """The states in front of the spans that `edges` cut a partition into, by composed functions."""
    prefix = np.concatenate([[0], np.cumsum(costs)])
    flips = np.flatnonzero(large)
    rows = []
    for at, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
        look = cuts._Outlook(at == 0)
        look.add(costs[a:b], large[a:b], budget, max_rows)
        runs = cuts._merged([look.starts + a, look.costs + prefix[a], b - look.held, prefix[b] - look.spent, look.begun])
        if at == len(edges) - 2:
            runs = [r[:0] for r in runs]
        place = {"part": 5, "at": at, "lo_row": a, "hi_row": b, "lo_cost": int(prefix[a]), "hi_cost": int(prefix[b]), "budget": budget}
        rows.append(place | {"flip": int(flips[0]) if len(flips) else cuts.NEVER} | dict(zip(cuts._RUNS, (r.tolist() for r in runs))))

    def batches(rows):
        kinds = [(n, pa.int64()) for n in cuts._RECORD] + [(n, pa.list_(pa.int64())) for n in cuts._RUNS]
        kinds += [(n, pa.int64()) for n in cuts._STATE if n in rows[0]]
        return iter(pa.Table.from_pylist(rows, pa.schema(kinds)).to_batches(7))

    levels = [rows]
    while len(levels[-1]) > cuts.FAN:
        levels.append([r for b in cuts._composed(batches(levels[-1]), max_rows, cuts.FAN) for r in b.to_pylist()])
    states = {0: dict.fromkeys(cuts._STATE, 0)}
    for level in reversed(levels):
        if level is levels[-1]:
            entered = [r | states[0] for r in level]
        else:
            entered = [r | {n: states[r["at"] // cuts.FAN][n] for n in cuts._STATE} for r in level]
        states = {r["at"]: r for b in cuts._entered(batches(entered), max_rows, cuts.FAN) for r in b.to_pylist()}
    return states, max(len(r["rows"]) for level in levels for r in level)


@pytest.mark.parametrize("seed", range(4))
def test_a_thousand_spans(monkeypatch, seed):
    """Composed states equal those of one walk over all rows, for spans smaller and larger than a group."""
    rng = np.random.default_rng(seed)
    monkeypatch.setattr(cuts, "FAN", [2, 5, 16, 64][seed])
    n = 6000
    costs = rng.choice([0, 1, 4, 9, 30, 200], n).astype(np.int64) if seed else np.full(n, 7)
    large = np.arange(n) >= rng.choice([n, n // 2, n - 3])
    budget, max_rows = [(100, 7), (60, 50), (500, 1000), (3000, 100)][seed]
    edges = [0, *np.sort(rng.choice(np.arange(1, n), 999, replace=False)).tolist(), n]
    states, _ = composed_states(costs, large, edges, budget, max_rows)
    groups = np.array(slow.cut(costs, large, budget, max_rows))
    starts = np.flatnonzero(np.diff(groups, prepend=-1))
    assert len(states) == 1000
    for at, a in enumerate(edges[1:-1], start=1):
        open_at = starts[groups[a - 1]]
        assert (states[at]["began"], states[at]["spent"], states[at]["groups"]) == (open_at, costs[:open_at].sum(), groups[a - 1] + 1), at


def test_functions_stay_small():
    """A list of runs does not grow with the rows that fit the budget: neighbouring starts meet in one end."""
    rng = np.random.default_rng(3)
    sizes = []
    for rows in (200, 1600):  # rows of a group
        n = rows * 40
        costs = rng.integers(1, 100, n)
        _, longest = composed_states(costs, np.zeros(n, dtype=bool), [0, n // 2, n], 50 * rows, 10**9)
        sizes.append(longest)
    assert sizes[1] < 2 * sizes[0] + 20 < 400


def box_of(row):
    return None if row.bbox.xmin is None else (row.bbox.xmin, row.bbox.ymin, row.bbox.xmax, row.bbox.ymax)


@pytest.mark.parametrize(
    "options",
    [
        layout.LayoutOptions(group_bytes=200_000),
        layout.LayoutOptions(group_bytes=20_000, large_fraction=0.0),
        layout.LayoutOptions(group_bytes=4_000, group_rows=11),
    ],
)
def test_search_equals_row_by_row(spark, sf, many_tasks, options):
    measures = features(spark, sf).withColumns(
        {"attribute_eighths": F.lit(801).cast("bigint") + F.col("fid") % 3, "geometry_kind": F.lit("Polygon")}
    ).select("part_key", "fid", "bbox", "geometry_kind", F.col("wkb_bytes").cast("bigint"), "attribute_eighths")
    extent = layout.measured_extent(measures, "part_key")
    costed = layout.costed_rows(measures, extent, "part_key")
    rows, chosen = layout.layout_search(costed, "part_key", ["fid"], options)
    picked = {r.part_key: r for r in chosen.collect()}
    got = {}
    for r in rows.collect():
        got.setdefault(r.part_key, []).append(r)
    source = {}
    for r in costed.collect():
        source.setdefault(r.part_key, []).append(r)
    assert set(got) == set(source)
    for key, mine in source.items():
        mine.sort(key=lambda r: (r.curve is None, r.curve or 0, r.fid))
        attempt, order, groups, ok = slow.chosen_layout([(r["size"], r.cost, box_of(r)) for r in mine], options, 1024)
        assert (picked[key].attempt, picked[key].order_ok) == (attempt, ok), key
        placed = sorted(got[key], key=lambda r: r.position)
        assert [r.fid for r in placed] == [mine[i].fid for i in order]
        assert [r.group_id for r in placed] == groups
        assert picked[key].group_bytes == options.budgets()[attempt // len(options.fractions())]
        assert picked[key].large_fraction == options.fractions()[attempt % len(options.fractions())]


def test_search_retries(spark, many_tasks):
    """Layouts that fail at first: some pass at a later attempt, some never do."""
    rows, fid = [], 0
    for key, n, share, often in (
        ("fourth", 100, 0.45, 0.3), ("eighth", 100, 0.7, 0.4), ("never", 230, 0.55, 0.3), ("first", 205, 0.0, 0.0),
        ("empty", 12, 0.0, 0.0),
    ):
        rng = random.Random(3)
        for i in range(n):
            big = rng.random() < often
            low, high = (30, 70) if big else (0, 100)
            x, y = rng.uniform(low, high), rng.uniform(low, high)
            w = share * 100 * (0.9 + 0.2 * rng.random()) if big else 0.5 * rng.random()
            missing = key == "empty" or (key == "first" and i % 31 == 0)
            sides = (None,) * 4 if missing else (x - w / 2, y - w / 2, x + w / 2, y + w / 2)
            rows.append((key, fid, *sides, 30 + i % 40))
            fid += 1
    df = spark.createDataFrame(
        rows, "part_key string, fid long, xmin double, ymin double, xmax double, ymax double, wkb_bytes long"
    ).withColumn("bbox", F.struct(*boxes.SIDES))
    measures = df.select(
        "part_key", "fid", "bbox", F.lit("Polygon").alias("geometry_kind"), "wkb_bytes",
        F.lit(160).cast("bigint").alias("attribute_eighths"),
    )
    options = layout.LayoutOptions(group_bytes=1600, group_rows=40)
    costed = layout.costed_rows(measures, layout.measured_extent(measures, "part_key"), "part_key")
    laid, chosen = layout.layout_search(costed, "part_key", ["fid"], options)
    picked = {r.part_key: r for r in chosen.collect()}
    got, source, seen = {}, {}, {}
    for r in laid.collect():
        got.setdefault(r.part_key, []).append(r)
    for r in costed.collect():
        source.setdefault(r.part_key, []).append(r)
    for key, mine in source.items():
        mine.sort(key=lambda r: (r.curve is None, r.curve or 0, r.fid))
        placed = sorted(got[key], key=lambda r: r.position)
        if key == "empty":  # no box at all: one run of groups in id order, nothing to check
            assert [r.fid for r in placed] == [r.fid for r in mine] and picked[key].attempt == 0
            continue
        attempt, order, groups, ok = slow.chosen_layout([(r["size"], r.cost, box_of(r)) for r in mine], options, 1024)
        seen[key] = (attempt, ok)
        assert (picked[key].attempt, picked[key].order_ok) == (attempt, ok), key
        assert [r.fid for r in placed] == [mine[i].fid for i in order]
        assert [r.group_id for r in placed] == groups
    assert seen["never"] == (0, False)
    assert len({a for a, _ in seen.values()}) >= 3, seen


def test_odd_partitions(spark):
    """One row, one box many times, points on a line, all rows over the budget, fraction 0 or not."""
    made = {
        "one": [(0, 0, 2, 1)],
        "same": [(0, 0, 1, 1)] * 6,
        "line": [(i, 0, i, 0) for i in range(210)],
        "half": [(i % 7, i % 5, i % 7 + 3.5, i % 5 + 0.1) for i in range(40)],
    }
    rows = [(k, i, *map(float, b), 50 + i % 3) for k, found in made.items() for i, b in enumerate(found)]
    measures = spark.createDataFrame(
        rows, "part_key string, fid long, xmin double, ymin double, xmax double, ymax double, wkb_bytes long"
    ).select(
        "part_key", "fid", F.struct(*boxes.SIDES).alias("bbox"), F.lit("Polygon").alias("geometry_kind"), "wkb_bytes",
        F.lit(80).cast("bigint").alias("attribute_eighths"),
    )
    costed = layout.costed_rows(measures, layout.measured_extent(measures, "part_key"), "part_key")
    for options in (
        layout.LayoutOptions(group_bytes=40), layout.LayoutOptions(group_bytes=122, group_rows=2),
        layout.LayoutOptions(group_bytes=400, group_rows=5, large_fraction=0.0),
    ):
        laid, chosen = layout.layout_search(costed, "part_key", ["fid"], options)
        picked = {r.part_key: r for r in chosen.collect()}
        got = {}
        for r in laid.collect():
            got.setdefault(r.part_key, []).append(r)
        source = {}
        for r in costed.collect():
            source.setdefault(r.part_key, []).append(r)
        for key, mine in source.items():
            mine.sort(key=lambda r: (r.curve, r.fid))
            attempt, order, groups, ok = slow.chosen_layout([(r["size"], r.cost, box_of(r)) for r in mine], options, 1024)
            placed = sorted(got[key], key=lambda r: r.position)
            assert (picked[key].attempt, picked[key].order_ok) == (attempt, ok), (key, options)
            assert [r.fid for r in placed] == [mine[i].fid for i in order]
            assert [r.group_id for r in placed] == groups


def test_search_tries_one_fraction_after_the_other(spark, monkeypatch):
    """A partition that passes at the second attempt is not cut for the later ones."""
    rng, rows = random.Random(3), []
    for i in range(100):
        big = rng.random() < 0.3
        x, y = (rng.uniform(30, 70), rng.uniform(30, 70)) if big else (rng.uniform(0, 100), rng.uniform(0, 100))
        w = 45.0 if big else 0.5 * rng.random()
        rows.append(("a", i, (x - w / 2, y - w / 2, x + w / 2, y + w / 2), "Polygon", 100, 80))
    measures = spark.createDataFrame(rows, "part_key string, fid bigint, bbox struct<xmin: double, ymin: double, xmax: double, ymax: double>, geometry_kind string, wkb_bytes bigint, attribute_eighths bigint")
    tried, plain = [], layout.try_layouts

    def recorded(costed, key, tie, options, attempts):
        tried.append([number for number, _, _ in attempts])
        return plain(costed, key, tie, options, attempts)

    monkeypatch.setattr(layout, "try_layouts", recorded)
    costed = layout.costed_rows(measures, layout.measured_extent(measures, "part_key"), "part_key")
    _, chosen = layout.layout_search(costed, "part_key", ["fid"], layout.LayoutOptions(group_bytes=1600, group_rows=40))
    assert [(r.attempt, r.order_ok) for r in chosen.collect()] == [(1, True)] and tried == [[0], [1]]


def test_features_join_once(spark, sf):
    """No evaluation of the features joins, or broadcasts, customers; rows are those of the join."""
    plan = spark._jvm.PythonSQLUtils.explainString(features(spark, sf)._jdf.queryExecution(), "formatted")
    assert "Join" not in plan and "Exchange" not in plan
    orders, customers = (spark.read.parquet(f"{sf}/{name}.parquet") for name in ("orders", "customer"))
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).selectExpr("o_orderkey", "lpad(string(c_nationkey), 2, '0')", "o_totalprice")
    assert sorted(features(spark, sf).select("fid", "part_key", "area_km2").collect()) == sorted(joined.collect())
