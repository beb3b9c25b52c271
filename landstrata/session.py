"""Session helpers: a local session for tests, the shared work folder, and guarded broadcasts."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# A side is broadcast only when it has been counted and holds at most this many rows and bytes.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024


def local_session(cores: int | str = "*", partitions: int = 8, **settings: str) -> SparkSession:
    """A session for tests and the bench; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("landstrata")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    )
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return ship(spark)


def ship(spark: SparkSession) -> SparkSession:
    """Sends this package to the Python workers, once per application, as `--py-files` would."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parent
        archive = Path(tempfile.mkdtemp(prefix="landstrata-package-")) / package.name
        shutil.make_archive(str(archive), "zip", package.parent, package.name)
        context.addPyFile(f"{archive}.zip")
        _SHIPPED.add(context.applicationId)
    return spark


_SHIPPED: set[str] = set()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach: the session's checkpoint directory.

    Where the cluster names none, a temporary folder serves local mode only; any other master must
    set `spark.checkpoint.dir`, because a machine-local folder would not survive a lost executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(named)
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="landstrata-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def fresh_folder(spark: SparkSession, label: str) -> str:
    """An unused path under the shared folder."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Compute `df` once into reliable storage, keeping its partitions and their order."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)


def materialise_observing(df: DataFrame, **measures: Column) -> tuple[DataFrame, dict]:
    """`materialise`, with aggregates taken on the way in the same job."""
    seen = Observation()
    stored = materialise(df.observe(seen, *(value.alias(name) for name, value in measures.items())))
    return stored, seen.get


_SHARED: dict[tuple, object] = {}


def shared(name: str, spark: SparkSession, sf_dir: str, make: Callable[[], object]):
    """What is made once per session and input."""
    at = (name, spark.sparkContext.applicationId, sf_dir)
    if at not in _SHARED:
        _SHARED[at] = make()
    return _SHARED[at]


def small_side(df: DataFrame, limit: int = BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """Materialise a summary table; hint a broadcast only if its counted size allows it. A column
    counts as 16 bytes, a text or binary one with its length."""
    long = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema.fields if f.dataType.simpleString() in ("string", "binary")]
    width = sum(long, F.lit(16 * len(df.columns)))
    stored, seen = materialise_observing(df, rows=F.count(F.lit(1)), bytes=F.sum(width))
    fits = seen["rows"] <= limit and (seen["bytes"] or 0) <= BROADCAST_BYTES
    return (F.broadcast(stored) if fits else stored), fits
