"""Files under a root as a table, their digests, and the digest of a whole tree."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landstrata.session import materialise_observing
from landstrata.sources import files


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """(path below the root, bytes) of every file, hidden and empty ones too; contents are not read.

    Spark's own file sources leave out empty files and names that begin with `_` or `.`, so the
    listing is done here, by tasks: all folders of one level at a time, each folder in one call. What
    was found is stored, and the driver learns only how many folders come next.
    """

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = files.filesystem(root)
        for batch in batches:
            for folder in batch.column("path").to_pylist():
                infos = system.get_file_info(pafs.FileSelector(f"{base}/{folder}".rstrip("/")))
                for a in range(0, len(infos), 10_000):
                    some = infos[a : a + 10_000]
                    paths = pa.array([i.path[len(base) :].lstrip("/") for i in some], pa.string())
                    kinds = pa.array([i.type == pafs.FileType.Directory for i in some], pa.bool_())
                    yield pa.RecordBatch.from_arrays([paths, pa.array([i.size for i in some], pa.int64()), kinds], ["path", "bytes", "folder"])

    folders, found, more = spark.createDataFrame([("",)], "path string"), None, 1
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    while more:
        dealt = folders.select("path").repartition(min(more, tasks), "path")
        listed = dealt.mapInArrow(walk, "path string, bytes bigint, folder boolean")
        level, seen = materialise_observing(listed, folders=F.count_if("folder"))
        kept = level.where("not folder").select("path", "bytes")
        found = kept if found is None else found.unionByName(kept)
        folders, more = level.where("folder"), seen["folders"]
    return found


def file_inventory(spark: SparkSession, root: str, exclude: tuple[str, ...] = ()) -> DataFrame:
    """(path, bytes, sha256) of every file under `root`, except files with an excluded name.

    Paths are dealt out to tasks, and each file is hashed in chunks, so neither many files nor a
    large one has to fit in memory.
    """
    listed = list_files(spark, root)
    if exclude:
        listed = listed.where(~F.element_at(F.split("path", "/"), -1).isin(list(exclude)))

    def hash_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = files.filesystem(root)
        for batch in batches:
            found = [files.digest(system, f"{base}/{path}") for path in batch.column("path").to_pylist()]
            sizes, digests = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("path"), pa.array(sizes, pa.int64()), pa.array(digests, pa.string())],
                ["path", "bytes", "sha256"],
            )

    return dealt_out(listed).mapInArrow(hash_files, "path string, bytes bigint, sha256 string")


def dealt_out(listed: DataFrame) -> DataFrame:
    """Paths spread over tasks, each path's work being large."""
    return listed.repartition(int(listed.sparkSession.conf.get("spark.sql.shuffle.partitions")), "path")


def path_order(path: Column) -> Column:
    """Sort key of a path: its components, so that `a/b` comes before `a-b`."""
    return F.split(path, "/")


def tree_digest(inventory: DataFrame, tree: str | None = None, skip_hidden: bool = True) -> DataFrame:
    """Files, bytes and the sha256 over sorted `path<TAB>sha256<LF>` lines, per tree.

    The lines are sorted by Spark and stream through one running hash per tree: the definition is
    sequential, but the task that follows a tree holds one batch of short lines, never the tree.
    """
    rows = inventory if tree else inventory.withColumn("tree", F.lit(""))
    name = tree or "tree"
    if skip_hidden:
        rows = rows.where(~F.element_at(F.split("path", "/"), -1).startswith("."))
    ordered = (
        rows.select(
            F.col(name).alias("tree"), path_order(F.col("path")).alias("_parts"), "bytes",
            F.concat("path", F.lit("\t"), "sha256", F.lit("\n")).alias("line"),
        )
        .repartition("tree")
        .sortWithinPartitions("tree", "_parts")
        .select("tree", "bytes", "line")
    )
    digests = ordered.mapInArrow(_digest_lines, "tree string, files bigint, bytes bigint, sha256 string")
    return digests.withColumnRenamed("tree", name) if tree else digests.drop("tree")


def _digest_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def row(tree, count, total, running):
        arrays = [pa.array([tree]), pa.array([count], pa.int64()), pa.array([total], pa.int64())]
        return pa.RecordBatch.from_arrays(
            [*arrays, pa.array([running.hexdigest()])], ["tree", "files", "bytes", "sha256"]
        )

    tree, count, total, running = None, 0, 0, None
    for batch in batches:
        lines = zip(*(batch.column(n).to_pylist() for n in ("tree", "bytes", "line")))
        for name, size, line in lines:
            if running is None or name != tree:
                if running is not None:
                    yield row(tree, count, total, running)
                tree, count, total, running = name, 0, 0, hashlib.sha256()
            count, total = count + 1, total + size
            running.update(line.encode("utf-8"))
    if running is not None:
        yield row(tree, count, total, running)
