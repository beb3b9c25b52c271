"""Envelope and kind of well-known-binary shapes, one Arrow batch at a time.

Spark has no envelope function for binary shapes, so this is the one expression that needs Python.
Shapes are read as bytes with numpy; nothing else about them is interpreted.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

FACTS_TYPE = "struct<xmin: double, ymin: double, xmax: double, ymax: double, kind: string, has_z: boolean>"

# Shape codes of the format and the names the catalog uses for them.
KINDS = {
    1: "Point",
    2: "LineString",
    3: "Polygon",
    4: "MultiPoint",
    5: "MultiLineString",
    6: "MultiPolygon",
    7: "GeometryCollection",
}
Z_BIT, M_BIT, SRID_BIT = 0x80000000, 0x40000000, 0x20000000
NOWHERE = (np.inf, np.inf, -np.inf, -np.inf)


def _header(shape: bytes, at: int) -> tuple[str, int, bool, int, int]:
    """(byte order, kind code, has z, ordinates per point, offset after the header)."""
    order = "<" if shape[at] == 1 else ">"
    (code,) = struct.unpack_from(order + "I", shape, at + 1)
    after = at + 5 + (4 if code & SRID_BIT else 0)
    iso = (code & 0x0FFFFFFF) // 1000
    has_z = bool(code & Z_BIT) or iso in (1, 3)
    has_m = bool(code & M_BIT) or iso in (2, 3)
    return order, (code & 0x0FFFFFFF) % 1000, has_z, 2 + has_z + has_m, after


def _run_box(shape: bytes, order: str, at: int, points: int, width: int) -> tuple[float, ...]:
    if points == 0:
        return NOWHERE
    run = np.frombuffer(shape, dtype=order + "f8", count=points * width, offset=at).reshape(points, width)[:, :2]
    run = run[~np.isnan(run).any(axis=1)]
    if not len(run):
        return NOWHERE
    low, high = run.min(axis=0), run.max(axis=0)
    return low[0], low[1], high[0], high[1]


def _around(boxes: list[tuple[float, ...]]) -> tuple[float, ...]:
    if not boxes:
        return NOWHERE
    xmin, ymin, xmax, ymax = zip(*boxes)
    return min(xmin), min(ymin), max(xmax), max(ymax)


def _extent(shape: bytes, at: int = 0) -> tuple[tuple[float, ...], int]:
    """(box, offset after the shape) of the shape that starts at `at`."""
    order, kind, _, width, at = _header(shape, at)
    step = 8 * width
    if kind == 1:
        return _run_box(shape, order, at, 1, width), at + step
    (count,) = struct.unpack_from(order + "I", shape, at)
    at += 4
    if kind == 2:
        return _run_box(shape, order, at, count, width), at + count * step
    boxes = []
    for _ in range(count):
        if kind == 3:
            (points,) = struct.unpack_from(order + "I", shape, at)
            boxes.append(_run_box(shape, order, at + 4, points, width))
            at += 4 + points * step
        else:
            part, at = _extent(shape, at)
            boxes.append(part)
    return _around(boxes), at


def shape_facts(shape: bytes | None) -> tuple | None:
    """(xmin, ymin, xmax, ymax, kind, has_z); box fields are None for a shape without points."""
    if shape is None:
        return None
    try:
        _, code, has_z, _, _ = _header(shape, 0)
        kind = KINDS[code]
        extent, _ = _extent(shape)
    except (IndexError, KeyError, ValueError, struct.error) as error:
        raise ValueError(f"not a well-known-binary shape: {shape[:16].hex()}...") from error
    placed = tuple(float(v) for v in extent) if extent[0] <= extent[2] else (None,) * 4
    return (*placed, kind, has_z)


# Rows walked together; when fewer are left, each is read by itself.
FEW = 16


class _Walk:
    """Reads the headers of all shapes of a batch in step: the n-th part or ring of every row at once.

    `runs` gathers where rows have points: (row, offset, points, ordinates of a point, little-endian).
    Each row has a stack of open containers (multi-shapes and collections, nested to any depth), as columns of
    arrays: how many members are left, and of what kind they must be. A step looks at rows that are still
    open only. Rows that are null, malformed, or the last few with many parts are left to `shape_facts`.
    """

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        self.data, self.ends = data, ends
        self.runs: list[tuple[np.ndarray, ...]] = []
        n = len(starts)
        self.at = starts.copy()
        self.little, self.width = np.zeros(n, bool), np.zeros(n, np.int64)
        self.fit = ends > starts
        self.kind, self.has_z = self._headers(np.flatnonzero(self.fit))
        self.fit &= (self.kind >= 1) & (self.kind <= 7)
        self.rings = np.zeros(n, np.int64)
        self.level = np.zeros(n, np.int64)
        self.left, self.wanted = np.zeros((2, n), np.int64), np.zeros((2, n), np.int64)

    def _numbers(self, rows: np.ndarray) -> np.ndarray:
        """The four-byte number at each row's place, which moves on; rows that end before it are unfit."""
        at = self.at[rows]
        inside = at + 4 <= self.ends[rows]
        self.fit[rows[~inside]] = False
        at = np.where(inside, at, 0)
        bytes_ = [self.data[at + k].astype(np.int64) if inside.any() else np.zeros(len(rows), np.int64) for k in range(4)]
        low = bytes_[0] | bytes_[1] << 8 | bytes_[2] << 16 | bytes_[3] << 24
        high = bytes_[3] | bytes_[2] << 8 | bytes_[1] << 16 | bytes_[0] << 24
        self.at[rows] += 4
        return np.where(self.little[rows], low, high)

    def _headers(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Kind and Z of the shape at each row's place; sets byte order and width, and moves on."""
        kind, has_z = np.zeros(len(self.at), np.int64), np.zeros(len(self.at), bool)
        inside = self.at[rows] < self.ends[rows]
        self.fit[rows[~inside]] = False
        rows = rows[inside]
        if not len(rows):
            return kind, has_z
        self.little[rows] = self.data[self.at[rows]] == 1
        self.at[rows] += 1
        code = self._numbers(rows)
        iso = (code & 0x0FFFFFFF) // 1000
        has_z[rows] = (code & Z_BIT != 0) | (iso == 1) | (iso == 3)
        has_m = (code & M_BIT != 0) | (iso == 2) | (iso == 3)
        self.at[rows] += np.where(code & SRID_BIT != 0, 4, 0)
        self.width[rows] = 2 + has_z[rows] + has_m
        kind[rows] = (code & 0x0FFFFFFF) % 1000
        return kind, has_z

    def _run(self, rows: np.ndarray, points: np.ndarray) -> None:
        size = points * self.width[rows] * 8
        inside = self.at[rows] + size <= self.ends[rows]
        self.fit[rows[~inside]] = False
        kept = inside & (points > 0)
        own = rows[kept]
        self.runs.append((own, self.at[own], points[kept], self.width[own], self.little[own]))
        self.at[rows] += np.where(inside, size, 0)

    def walk(self) -> None:
        rows = np.flatnonzero(self.fit)
        self._begin(rows, self.kind[rows])
        while True:
            rows = rows[self.fit[rows] & ((self.rings[rows] > 0) | (self.level[rows] > 0))]
            if len(rows) < FEW:
                self.fit[rows] = False
                return
            ring = rows[self.rings[rows] > 0]
            self.rings[ring] -= 1
            self._run(ring, self._numbers(ring))
            inner = rows[(self.rings[rows] == 0) & (self.level[rows] > 0) & self.fit[rows]]
            top = self.level[inner] - 1
            full = self.left[top, inner] == 0
            self.level[inner[full]] -= 1
            inner, top = inner[~full], top[~full]
            self.left[top, inner] -= 1
            kind, _ = self._headers(inner)
            wanted, kind = self.wanted[top, inner], kind[inner]
            self.fit[inner] &= ((wanted == 0) | (kind == wanted)) & (kind >= 1) & (kind <= 7)
            kept = self.fit[inner]
            self._begin(inner[kept], kind[kept])

    def _begin(self, rows: np.ndarray, kinds: np.ndarray) -> None:
        """After a header: a point has its run at once, a line one run to come, a polygon its rings; a
        container is opened."""
        point = rows[kinds == 1]
        self._run(point, np.ones(len(point), np.int64))
        self.rings[rows[kinds == 2]] = 1
        polygon = rows[kinds == 3]
        self.rings[polygon] = self._numbers(polygon)
        several = kinds > 3
        outer, members = rows[several], np.where(kinds[several] < 7, kinds[several] - 3, 0)
        count = self._numbers(outer)
        if len(outer) and self.level[outer].max() == len(self.left):
            self.left, self.wanted = (np.concatenate([x, np.zeros_like(x)]) for x in (self.left, self.wanted))
        self.left[self.level[outer], outer], self.wanted[self.level[outer], outer] = count, members
        self.level[outer] += 1

    def boxes(self) -> np.ndarray:
        """Lowest and highest x and y of every row; infinite where it has no point. A point counts if both
        its ordinates are numbers."""
        out = np.empty((len(self.at), 4))
        out[:] = NOWHERE
        if not self.runs:
            return out
        row, at, points, width, little = (np.concatenate(x) for x in zip(*self.runs))
        group = (at % 8) * 8 + width * 2 + little
        for found in np.unique(group):
            own = np.flatnonzero(group == found)
            shift, order = int(at[own[0]] % 8), "<f8" if little[own[0]] else ">f8"
            words = self.data[shift : shift + (len(self.data) - shift) // 8 * 8].view(order)
            ends = np.cumsum(points[own])
            first = ends - points[own]
            step = int(width[own[0]])
            place = np.repeat((at[own] - shift) // 8 - first * step, points[own]) + np.arange(ends[-1]) * step
            x, y = words[place].astype("f8", copy=False), words[place + 1].astype("f8", copy=False)
            lost = np.isnan(x) | np.isnan(y)
            for side, values, reduce, none in ((0, x, np.minimum, np.inf), (1, y, np.minimum, np.inf), (2, x, np.maximum, -np.inf), (3, y, np.maximum, -np.inf)):
                values = np.where(lost, none, values) if lost.any() else values
                reduce.at(out[:, side], row[own], reduce.reduceat(values, first))
        return out


def _batch_facts(shapes: pa.Array) -> pa.Array:
    if isinstance(shapes, pa.ChunkedArray):
        shapes = shapes.combine_chunks()
    shapes = shapes.cast(pa.binary())
    n = len(shapes)
    kinds, has_z, placed = np.empty(n, object), np.zeros(n, bool), np.zeros(n, bool)
    columns = [np.full(n, np.nan) for _ in range(4)]
    done = np.zeros(n, bool)
    if n and shapes.buffers()[2] is not None and shapes.buffers()[2].size:
        offsets = np.frombuffer(shapes.buffers()[1], dtype=np.int32)[shapes.offset : shapes.offset + n + 1].astype(np.int64)
        walk = _Walk(np.frombuffer(shapes.buffers()[2], dtype=np.uint8), offsets[:-1], offsets[1:])
        walk.walk()
        done = walk.fit & shapes.is_valid().to_numpy(zero_copy_only=False)
        found = walk.boxes()
        placed = done & (found[:, 0] <= found[:, 2])
        for column, values in zip(columns, found.T):
            column[placed] = values[placed]
        kinds[done] = np.array([KINDS.get(k) for k in range(8)], object)[walk.kind[done]]
        has_z = walk.has_z & done
    for row in np.flatnonzero(~done):
        facts = shape_facts(shapes[int(row)].as_py())
        if facts is not None:
            kinds[row], has_z[row] = facts[4], facts[5]
            if facts[0] is not None:
                placed[row] = True
                for column, value in zip(columns, facts):
                    column[row] = value
    sides = [pa.array(column, pa.float64(), mask=~placed) for column in columns]
    unknown = np.equal(kinds, None)
    fields = [*sides, pa.array(kinds, pa.string()), pa.array(has_z, pa.bool_(), mask=unknown)]
    return pa.StructArray.from_arrays(fields, ["xmin", "ymin", "xmax", "ymax", "kind", "has_z"])


def shape_column(geometry: Column | str) -> Column:
    """Struct of box sides, kind and has_z for a binary column."""

    @F.arrow_udf(FACTS_TYPE)
    def facts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for shapes in batches:
            yield _batch_facts(shapes)

    return facts(geometry)


def kind_label(kind: Column, has_z: Column) -> Column:
    return F.concat(kind, F.when(has_z, F.lit(" Z")).otherwise(F.lit("")))


def rectangle_column(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    """A box as a little-endian polygon of five points; null where the box is null."""

    @F.arrow_udf("binary")
    def rectangles(w: pa.Array, s: pa.Array, e: pa.Array, n: pa.Array) -> pa.Array:
        size = 13 + 5 * 16
        sides = [v.to_numpy(zero_copy_only=False).astype("<f8") for v in (w, s, e, n)]
        west, south, east, north = sides
        bytes_ = np.empty((len(west), size), np.uint8)
        bytes_[:, :13] = np.frombuffer(struct.pack("<BIII", 1, 3, 1, 5), np.uint8)
        corners = [west, south, east, south, east, north, west, north, west, south]
        bytes_[:, 13:] = np.stack(corners, axis=1).view(np.uint8)
        offsets = pa.array(np.arange(len(west) + 1, dtype=np.int32) * size)
        validity = pa.array(~np.isnan(west)).buffers()[1]
        return pa.Array.from_buffers(
            pa.binary(), len(west), [validity, offsets.buffers()[1], pa.py_buffer(bytes_.tobytes())]
        )

    return rectangles(xmin, ymin, xmax, ymax)


def ringed_column(xmin: Column, ymin: Column, xmax: Column, ymax: Column, points: int = 96) -> Column:
    """A little-endian multipolygon of two one-ring polygons, an ellipse that fills the box and one inside
    it, of `points` points each; null where the box is null."""

    @F.arrow_udf("binary")
    def ringed(w: pa.Array, s: pa.Array, e: pa.Array, n: pa.Array) -> pa.Array:
        west, south, east, north = (v.to_numpy(zero_copy_only=False) for v in (w, s, e, n))
        angle = np.append(np.linspace(0, 2 * np.pi, points - 1, endpoint=False), 0)
        part = 13 + 16 * points
        bytes_ = np.empty((len(west), 9 + 2 * part), np.uint8)
        bytes_[:, :9] = np.frombuffer(struct.pack("<BII", 1, 6, 2), np.uint8)
        for k, share in enumerate((0.5, 0.25)):
            at = 9 + k * part
            x = (west + east)[:, None] / 2 + (east - west)[:, None] * share * np.cos(angle)
            y = (south + north)[:, None] / 2 + (north - south)[:, None] * share * np.sin(angle)
            bytes_[:, at : at + 13] = np.frombuffer(struct.pack("<BIII", 1, 3, 1, points), np.uint8)
            bytes_[:, at + 13 : at + part] = np.ascontiguousarray(np.stack([x, y], axis=2), "<f8").reshape(len(west), -1).view(np.uint8)
        rows = [None if np.isnan(west[i]) else bytes_[i].tobytes() for i in range(len(west))]
        return pa.array(rows, pa.binary())

    return ringed(xmin, ymin, xmax, ymax)
