"""One long JSON document read by many tasks.

Spark's text source cuts a file into byte ranges and each range into pieces at commas, wherever those
are. What a piece means depends on what comes before it: whether a comma lay inside a string, and how
deep. A piece says how many quotes and brackets it has for either case, and these add up: pieces
within a range, then ranges within a file, of which there is one row each. With its state a piece can
tell where entries of a container begin, and the pieces of one entry, few, are put together and
parsed by themselves. No task holds a document.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from landstrata.session import materialise, ship

_SPLIT = ["file", "block"]
_TOKEN = re.compile(r'"((?:[^"\\]|\\.)*)("?)|[\[\]{}]', re.S)
_REST = re.compile(r'(?:[^"\\]|\\.)*"', re.S)


def pieces(spark: SparkSession, pattern: str) -> DataFrame:
    """(file, block, n, text, inside, depth): the pieces of all files that match, in the order of (block, n),
    whether each begins inside a string, and in how many containers."""
    ship(spark)
    raw = spark.read.text(pattern, lineSep=",").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("n"), F.col("value").alias("text"),
    )
    plain = F.split(F.regexp_replace("text", r"(?s)\\.", ""), '"')
    count = lambda part, kind: F.length(F.regexp_replace(part, kind, ""))

    def deeper(odd: int) -> Column:
        parts = F.filter(plain, lambda _, i: i % 2 == odd)
        return F.aggregate(parts, F.lit(0), lambda total, part: total + count(part, r"[^\[{]") - count(part, r"[^\]}]"))

    raw = materialise(raw.select("*", ((F.size(plain) - 1) % 2).alias("quotes"), deeper(0).alias("if_out"), deeper(1).alias("if_in")))
    before = Window.partitionBy(*_SPLIT).orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    odd = F.coalesce(F.sum("quotes").over(before), zero) % 2
    raw = raw.withColumn("odd", odd)
    # By whether the range begins outside a string or inside one.
    raw = raw.withColumns({"out": F.when(F.col("odd") == 0, F.col("if_out")).otherwise(F.col("if_in")), "in": F.when(F.col("odd") == 0, F.col("if_in")).otherwise(F.col("if_out"))})
    ranges = raw.groupBy(*_SPLIT).agg(F.sum("quotes").alias("quotes"), F.sum("out").alias("out"), F.sum("in").alias("in"))
    along = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("began", F.coalesce(F.sum("quotes").over(along), zero) % 2)
    own = F.when(F.col("began") == 0, F.col("out")).otherwise(F.col("in"))
    ranges = ranges.withColumn("own", own).withColumn("above", F.coalesce(F.sum("own").over(along), zero)).select(*_SPLIT, "began", "above")
    placed = raw.join(ranges, _SPLIT).withColumn("own", F.when(F.col("began") == 0, F.col("out")).otherwise(F.col("in")))
    depth = F.col("above") + F.coalesce(F.sum("own").over(before), zero)
    return placed.select(*_SPLIT, "n", "text", ((F.col("began") + F.col("odd")) % 2 == 1).alias("inside"), depth.alias("depth"))


def entries(cut: DataFrame, depth: int, section: str | None = None, member: str | None = None) -> DataFrame:
    """(file, parent, section, entry, text) of the entries of containers that lie `depth` deep, as text.

    `cut` comes from `pieces`. `section` keeps containers that are members of that name, `member` entries
    that are. Sections are numbered along a file, and so are their parents, the containers around them.
    """
    schema = "file string, block bigint, n bigint, text string, opens int, parents int, name string, starts int, key string, within boolean"
    marked = materialise(cut.mapInArrow(partial(_marked, depth=depth), schema))
    numbered = _counted(marked, {"section": "opens", "parent": "parents", "entry": "starts"}).where("within")
    if section is not None:
        wanted = numbered.where((F.col("opens") > 0) & (F.col("name") == section)).select("file", "section")
        numbered = numbered.join(wanted, ["file", "section"], "left_semi")
    if member is not None:
        wanted = numbered.where((F.col("starts") > 0) & (F.col("key") == member)).select("file", "entry")
        numbered = numbered.join(wanted, ["file", "entry"], "left_semi")
    parts = F.sort_array(F.collect_list(F.struct("block", "n", "text")))["text"]
    whole = numbered.groupBy("file", "entry").agg(F.min("parent").alias("parent"), F.min("section").alias("section"), F.array_join(parts, ",").alias("text"))
    return whole.where(F.trim("text") != "").select("file", "parent", "section", "entry", "text")


def _counted(rows: DataFrame, sums: dict[str, str]) -> DataFrame:
    """Running sums along a file, up to and with each piece: within its range, and over the ranges before."""
    ranges = rows.groupBy(*_SPLIT).agg(*(F.sum(c).alias(name) for name, c in sums.items()))
    along = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(*_SPLIT, *(F.coalesce(F.sum(name).over(along), F.lit(0)).alias(f"before_{name}") for name in sums))
    upto = Window.partitionBy(*_SPLIT).orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    found = rows.select("*", *(F.sum(c).over(upto).alias(name) for name, c in sums.items())).join(ranges, _SPLIT)
    return found.withColumns({name: F.col(name) + F.col(f"before_{name}") for name in sums}).drop(*(f"before_{name}" for name in sums))


# ---- inside a task -------------------------------------------------------------------------------


def marks(text: str, inside: bool, at: int, depth: int) -> tuple:
    """(text in a container `depth` deep, containers that open there, containers around them that open, the
    name of the one that opens, entries that begin, the name of that entry, whether any of it lies within).

    A comma lies between two containers of one depth, so a piece sees one of them open or close at most.
    """
    first, last = 0, len(text)
    within, opens, parents, name = at >= depth, 0, 0, None
    starts, key, said, waiting = int(at == depth and not inside), None, None, at == depth and not inside
    place = 0
    if inside:
        closed = _REST.match(text)
        if closed is None:
            return text if within else "", 0, 0, None, 0, None, within
        place = closed.end()
    for token in _TOKEN.finditer(text, place):
        kind = token[0][0]
        if kind == '"':
            said = token[1] if token[2] and text[token.end() :].lstrip()[:1] == ":" else None
            if waiting and said is not None:
                key, waiting = json.loads(f'"{said}"'), False
        elif kind in "[{":
            at += 1
            if at == depth:
                first, opens, starts, within, waiting = token.end(), 1, 1, True, True
                name = json.loads(f'"{said}"') if said is not None else None
            elif at == depth - 1:
                parents += 1
            said = None
        else:
            if at == depth:
                last = token.start()
            at -= 1
            said = None
    return text[first:last] if within else "", opens, parents, name, starts, key, within


def _marked(batches: Iterator[pa.RecordBatch], depth: int) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string(), pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.string(), pa.bool_()]
    names = ["text", "opens", "parents", "name", "starts", "key", "within"]
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("text", "inside", "depth"))
        rows = [marks(text, inside, at, depth) for text, inside, at in zip(*columns)]
        arrays = [pa.array(list(c), type=t) for c, t in zip(zip(*rows), kinds)] if rows else [pa.array([], type=t) for t in kinds]
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("file", "block", "n")] + arrays, ["file", "block", "n", *names])
