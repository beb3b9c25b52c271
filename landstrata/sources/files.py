"""Paths, small documents and digests on any file system the session can reach."""

from __future__ import annotations

import ctypes
import gc
import hashlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession

CHUNK = 8 * 1024 * 1024


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI as Spark prints it (`file:/x`, `s3a://b/x`, `hdfs://n/x`, `/x`)."""
    if uri.startswith("file:"):
        uri = "/" + uri[len("file:") :].lstrip("/")
    for ours in ("s3a://", "s3n://"):
        uri = uri.replace(ours, "s3://", 1) if uri.startswith(ours) else uri
    return pafs.FileSystem.from_uri(uri)


def digest(system: pafs.FileSystem, path: str) -> tuple[int, str]:
    """Bytes and sha256 of a file, read in chunks."""
    total, running = 0, hashlib.sha256()
    with system.open_input_stream(path) as stream:
        while chunk := stream.read(CHUNK):
            total += len(chunk)
            running.update(chunk)
    return total, running.hexdigest()


def release_memory() -> None:
    """Gives what a task's large footers took back to the system. Spark keeps Python workers and lets them
    take turns, so each would go on holding what the largest file it has met took."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc keeps freed memory so
    if trim is not None:
        trim(0)


def write_documents(pieces: DataFrame, root: str) -> DataFrame:
    """Writes pieces (path, section, name, text) as files under `root`; returns (path, bytes).

    A document is its pieces by section and name; between two pieces of an odd section goes a comma.
    Documents are dealt out to tasks by path, and a task streams one piece after the other, so neither
    many documents nor a long one has to fit in memory. Writing the same text to the same name again is
    harmless, so a repeated task is too.
    """
    tasks = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = pieces.select("path", "section", "name", "text").repartition(tasks, "path").sortWithinPartitions("path", "section", "name")
    return rows.mapInArrow(partial(_stream_documents, root=root), "path string, bytes bigint")


def _stream_documents(batches: Iterator[pa.RecordBatch], root: str) -> Iterator[pa.RecordBatch]:
    system, base = filesystem(root)
    path, section, stream, done = None, None, None, []
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("path", "section", "text"))
        for own, part, text in zip(*columns):
            if own != path:
                if stream is not None:
                    done.append((path, stream.tell()))
                    stream.close()
                path, section = own, None
                system.create_dir(f"{base}/{path}".rsplit("/", 1)[0], recursive=True)
                stream = system.open_output_stream(f"{base}/{path}")
            stream.write((("," if part % 2 and part == section else "") + text).encode("utf-8"))
            section = part
        if done:
            yield _sizes(done)
            done = []
    if stream is not None:
        done.append((path, stream.tell()))
        stream.close()
        yield _sizes(done)


def _sizes(done: list[tuple[str, int]]) -> pa.RecordBatch:
    paths, sizes = zip(*done)
    return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(sizes, pa.int64())], ["path", "bytes"])


def hadoop(spark: SparkSession, path: str):
    """(Hadoop file system, Hadoop path) for the few whole-directory steps the driver does."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    system, target = hadoop(spark, path)
    return system.exists(target)


def renames_at_once(spark: SparkSession, path: str) -> bool:
    """Whether a folder there takes a new name in one step; object stores copy every object instead."""
    _, target = hadoop(spark, path)
    return (target.toUri().getScheme() or "file") in ("file", "hdfs", "viewfs", "abfs", "abfss")


def rename(spark: SparkSession, source: str, target: str) -> None:
    system, old = hadoop(spark, source)
    _, new = hadoop(spark, target)
    if system.exists(new) or not system.rename(old, new):
        raise FileExistsError(f"could not rename {source} to {target}")


def delete(spark: SparkSession, path: str) -> None:
    system, target = hadoop(spark, path)
    system.delete(target, True)
