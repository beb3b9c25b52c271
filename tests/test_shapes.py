import random
import struct

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from landstrata.functions import boxes, codes, hilbert, wkb
from landstrata.operators import covering


def ring(points, order="<", width=2):
    return struct.pack(order + "I", len(points)) + b"".join(struct.pack(order + f"{width}d", *p) for p in points)


def head(code, order="<"):
    return struct.pack("B", order == "<") + struct.pack(order + "I", code)


SQUARE = [(0.0, 1.0), (4.0, 1.0), (4.0, 5.0), (0.0, 5.0), (0.0, 1.0)]
POLYGON = head(3) + struct.pack("<I", 1) + ring(SQUARE)
BIG = head(3, ">") + struct.pack(">I", 2) + ring(SQUARE, ">") + ring([(1.0, 2.0), (9.0, 2.5), (1.0, 2.0)], ">")
POINT = head(1) + struct.pack("<2d", -7.0, 8.0)
SHAPES = {
    "little endian": (POLYGON, (0, 1, 4, 5), "Polygon"),
    "big endian, two rings": (BIG, (0, 1, 9, 5), "Polygon"),
    "iso z point": (head(1001) + struct.pack("<3d", 1, 2, 99), (1, 2, 1, 2), "Point Z"),
    "ewkb z and srid": (head(1 | 0x80000000 | 0x20000000) + struct.pack("<I3d", 4269, 1, 2, 99), (1, 2, 1, 2), "Point Z"),
    "iso m line": (head(2002) + ring([(1, 2, 50), (3, 1, 60)], width=3), (1, 1, 3, 2), "LineString"),
    "iso zm line": (head(3002) + ring([(1, 2, 5, 6), (3, 1, 7, 8)], width=4), (1, 1, 3, 2), "LineString Z"),
    "multipoint": (head(4) + struct.pack("<I", 2) + POINT + head(1) + struct.pack("<2d", 1, 1), (-7, 1, 1, 8), "MultiPoint"),
    "multiline": (head(5) + struct.pack("<I", 1) + head(2) + ring([(1, 2), (3, 1)]), (1, 1, 3, 2), "MultiLineString"),
    "mixed byte orders": (head(6, ">") + struct.pack(">I", 2) + POLYGON + BIG, (0, 1, 9, 5), "MultiPolygon"),
    "nested collection": (
        head(7) + struct.pack("<I", 2) + POINT + head(7) + struct.pack("<I", 1) + POLYGON,
        (-7, 1, 4, 8),
        "GeometryCollection",
    ),
    "empty polygon": (head(3) + struct.pack("<I", 0), None, "Polygon"),
    "empty point": (head(1) + struct.pack("<2d", float("nan"), float("nan")), None, "Point"),
    "empty collection": (head(7) + struct.pack("<I", 0), None, "GeometryCollection"),
    "collection with an empty part": (head(7) + struct.pack("<I", 2) + head(3) + struct.pack("<I", 0) + POINT, (-7, 8, -7, 8), "GeometryCollection"),
    "none": (None, None, None),
}


def test_shapes(spark):
    df = spark.createDataFrame([(k, v[0]) for k, v in SHAPES.items()], "name string, shape binary")
    got = {r.name: r for r in covering.with_covering(df, "shape").collect()}
    for name, (_, box, kind) in SHAPES.items():
        assert tuple(got[name].bbox) == (box or (None,) * 4), name
        assert got[name].geometry_kind == kind, name


def test_not_a_shape(spark):
    df = spark.createDataFrame([(bytearray(b"\x01\x63\x00"),)], "shape binary")
    with pytest.raises(Exception, match="not a well-known-binary shape"):
        covering.with_covering(df, "shape").collect()


def classic(x, y, bits=16):
    index, step = 0, 1 << (bits - 1)
    while step:
        rx, ry = int(x & step > 0), int(y & step > 0)
        index += step * step * ((3 * rx) ^ ry)
        if not ry:
            if rx:
                x, y = (1 << bits) - 1 - x, (1 << bits) - 1 - y
            x, y = y, x
        step >>= 1
    return index


def test_curve(spark):
    df = spark.range(3000).selectExpr("cast(id * 7919 % 65536 as int) x", "cast(id * 104729 % 65536 as int) y")
    for r in df.withColumn("h", hilbert.curve_index(F.col("x"), F.col("y"))).collect():
        assert r.h == classic(r.x, r.y)


def test_cells(spark):
    df = spark.createDataFrame(
        [(0.0, 0.0, 10.0), (10.0, 0.0, 10.0), (5.0, 5.0, 5.0), (None, 0.0, 10.0), (None, None, None), (5.0, 0.0, 10.0)],
        "v double, low double, high double",
    )
    cells = [r[0] for r in df.select(hilbert.grid_cell(F.col("v"), F.col("low"), F.col("high"))).collect()]
    assert cells == [0, 65535, 0, None, None, 32767]


def test_box_predicates(spark):
    rows = [(0.0, 0.0, 1.0, 1.0), (1.0, 0.0, 2.0, 1.0), (1.1, 0.0, 2.0, 1.0), (None,) * 4]
    df = spark.createDataFrame(rows, "xmin double, ymin double, xmax double, ymax double").select(F.struct("*").alias("bbox"))
    area = (-5.0, -5.0, 1.0, 5.0)
    assert [r[0] for r in df.select(boxes.intersects(area)).collect()] == [True, True, False, None]
    assert [r[0] for r in df.select(boxes.overlaps(area)).collect()] == [True, False, False, None]


def test_clamp(spark):
    rows = [(-180.00000000006, -95.0, 180.5, 91.0), (-179.23, 51.2, 179.86, 71.4), (None,) * 4]
    df = spark.createDataFrame(rows, "xmin double, ymin double, xmax double, ymax double").select(F.struct("*").alias("bbox"))
    got = [tuple(r[0]) for r in df.select(boxes.clamp_wgs84()).collect()]
    assert got == [(-180.0, -90.0, 180.0, 90.0), rows[1], (None,) * 4]


def test_codes(spark):
    rows = [("160101010101", True), ("160101010101\n", False), ("16010101010x", False), ("1601", False), (None, False), ("١" * 12, False)]
    df = spark.createDataFrame(rows, "code string, ok boolean")
    assert df.where(codes.code_valid("code", 12) != F.col("ok")).isEmpty()


def test_labels(spark):
    states = spark.createDataFrame([("UT",), ("ZZ",), ("UNKF",)], "value string")
    assert [r.label for r in codes.with_state_label(states, "value").orderBy("value").collect()] == [
        "Unknown (marine and offshore)", "Utah", "ZZ",
    ]
    regions = spark.createDataFrame([("16",), ("99",)], "value string")
    assert [r.label for r in codes.with_region_label(regions, "value").orderBy("value").collect()] == ["Region 16 Great Basin", "Region 99"]
    titles = codes.level_names(spark).orderBy("level").select(codes.level_title(F.col("level"), F.col("plural"), "2026-09-02"))
    titles = [r[0] for r in titles.collect()]
    assert titles[0] == "WBD HUC2 regions (2026-09-02) by HUC2 region" and titles[-1] == "WBD HUC16 (2026-09-02) by HUC2 region"


def test_random_rectangles_round_trip(spark):
    df = spark.range(500).selectExpr("id", "id * 0.1 a", "id * -0.3 b").selectExpr(
        "id", "if(id % 7 = 0, null, a) xmin", "if(id % 7 = 0, null, b) ymin", "if(id % 7 = 0, null, a + 1) xmax", "if(id % 7 = 0, null, b + 2) ymax"
    ).selectExpr("id", *(f"cast({s} as double) {s}" for s in boxes.SIDES))
    shaped = df.withColumn("g", wkb.rectangle_column(*(F.col(s) for s in boxes.SIDES)))
    rows = shaped.withColumn("f", wkb.shape_column("g")).collect()
    for r in rows:
        assert (r.f.xmin, r.f.ymin, r.f.xmax, r.f.ymax) == (r.xmin, r.ymin, r.xmax, r.ymax)
        assert r.f.kind == (None if r.xmin is None else "Polygon")
    assert len(rows) == 500


def test_walk_equals_reading_one_by_one():
    """Batches of random shapes of every kind, both byte orders, Z and M, some cut off or null."""
    rng = random.Random(11)

    def points(n, width):
        return [tuple(rng.choice([rng.uniform(-9, 9), rng.uniform(-9, 9), float("nan")] if rng.random() < 0.05 else [rng.uniform(-9, 9)]) for _ in range(width)) for _ in range(n)]

    def shape(kind, depth=0):
        order, extra = rng.choice("<>"), rng.choice([0, 1000, 2000, 3000])
        width = {0: 2, 1000: 3, 2000: 3, 3000: 4}[extra]
        start = head(kind + extra, order)
        if kind == 1:
            return start + struct.pack(order + f"{width}d", *points(1, width)[0])
        if kind == 2:
            return start + ring(points(rng.randint(0, 5), width), order, width)
        n = rng.randint(0, 4)
        if kind == 3:
            return start + struct.pack(order + "I", n) + b"".join(ring(points(rng.randint(0, 6), width), order, width) for _ in range(n))
        parts = b"".join(shape(kind - 3 if kind < 7 else rng.randint(1, 7 if depth < 2 else 3), depth + 1) for _ in range(n))
        return start + struct.pack(order + "I", n) + parts

    for _ in range(20):
        shapes = [None if rng.random() < 0.05 else shape(rng.choice([1, 2, 3, 3, 4, 5, 6, 6, 6, 7])) for _ in range(rng.randint(0, 150))]
        got = wkb._batch_facts(pa.array([None, *shapes], pa.binary())[1:]).to_pylist()
        for row, facts in zip(shapes, got):
            want = wkb.shape_facts(row) or (None,) * 6
            assert tuple(facts[n] for n in ("xmin", "ymin", "xmax", "ymax", "kind", "has_z")) == want
    for cut in (3, 8, 12, 40):
        with pytest.raises(ValueError, match="not a well-known-binary shape"):
            wkb._batch_facts(pa.array([POLYGON] * 40 + [BIG[:cut]], pa.binary()))


def test_multipolygons_are_walked_together(monkeypatch):
    """No row of a batch of ordinary multipolygons is read by itself."""
    shape = head(6) + struct.pack("<I", 2) + POLYGON + head(3) + struct.pack("<I", 2) + ring(SQUARE) + ring(SQUARE)
    monkeypatch.setattr(wkb, "shape_facts", None)
    assert set(wkb._batch_facts(pa.array([shape] * 100, pa.binary())).field("kind").to_pylist()) == {"MultiPolygon"}


def test_nested_collections_in_step():
    """Collections of any depth, empty ones, wrong members and cut-off ones, as shape by shape."""
    rng = random.Random(11)

    def point():
        return struct.pack("<BIdd", 1, 1, rng.choice([rng.random(), float("nan")]), rng.random())

    def line(n):
        return struct.pack(">BII", 0, 2, n) + struct.pack(f">{2 * n}d", *(rng.random() for _ in range(2 * n)))

    def polygon(n):
        return struct.pack("<BII", 1, 3, n) + b"".join(struct.pack("<I", 3) + struct.pack("<6d", *(rng.random() for _ in range(6))) for _ in range(n))

    def shape(depth):
        kind = rng.choice([1, 2, 3, 4, 6, 7, 7] if depth else [1, 2, 3])
        if kind <= 3:
            return (point, lambda: line(rng.randint(0, 4)), lambda: polygon(rng.randint(0, 3)))[kind - 1]()
        members = [shape(depth - 1) if kind == 7 else (point() if kind == 4 else polygon(rng.randint(1, 2))) for _ in range(rng.randint(0, 4))]
        return struct.pack("<BII", 1, kind, len(members)) + b"".join(members)

    shapes = [shape(rng.randint(0, 7)) for _ in range(400)] + [None]
    found = wkb._batch_facts(pa.array(shapes, pa.binary())).to_pylist()
    for given, got in zip(shapes, found):
        want = wkb.shape_facts(given)
        names = ["xmin", "ymin", "xmax", "ymax", "kind", "has_z"]
        assert got == (dict.fromkeys(names) if want is None else dict(zip(names, want)))
    with pytest.raises(ValueError, match="not a well-known-binary"):
        wkb._batch_facts(pa.array([shape(5) for _ in range(30)] + [struct.pack("<BII", 1, 7, 2) + point()], pa.binary()))
