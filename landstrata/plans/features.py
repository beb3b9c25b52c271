"""A feature table derived from the order and customer tables, used by the registered queries.

The text below runs unchanged in Spark SQL and in the checking engine. Every order becomes a feature
with a unique id, a partition (the customer's nation), a unit code, a box and a shape size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landstrata.functions import boxes, wkb
from landstrata.session import materialise, shared

FEATURES_SQL = """
SELECT fid, part_key, huc12, gap_sts, area_km2, tohuc,
       CASE WHEN fid % 997 = 996 THEN NULL ELSE cx - side / 2 END AS xmin,
       CASE WHEN fid % 997 = 996 THEN NULL ELSE cy - side / 2 END AS ymin,
       CASE WHEN fid % 997 = 996 THEN NULL ELSE cx + side / 2 END AS xmax,
       CASE WHEN fid % 997 = 996 THEN NULL ELSE cy + side / 2 END AS ymax,
       40 + 16 * (fid % 100) + CASE WHEN fid % 500 = 0 THEN 3000000 ELSE 0 END AS wkb_bytes
FROM (
  SELECT o_orderkey AS fid,
         lpad(CAST(c_nationkey AS STRING), 2, '0') AS part_key,
         concat(lpad(CAST(c_nationkey AS STRING), 2, '0'), lpad(CAST(o_orderkey AS STRING), 10, '0')) AS huc12,
         concat(lpad(CAST(c_nationkey AS STRING), 2, '0'), lpad(CAST(o_orderkey + 25 AS STRING), 10, '0')) AS tohuc,
         CAST(1 + o_orderkey % 4 AS STRING) AS gap_sts,
         o_totalprice AS area_km2,
         -120e0 + ((o_orderkey * 7919) % 60000) / 1e3 AS cx,
         25e0 + ((o_orderkey * 104729) % 25000) / 1e3 AS cy,
         CASE WHEN o_orderkey % 200 = 0 THEN 40e0 ELSE 1e-2 + (o_orderkey % 50) / 1e3 END AS side
  FROM orders JOIN customer ON o_custkey = c_custkey
) q
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


JOINED = "orders JOIN customer ON o_custkey = c_custkey"


def orders_of_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders with their customers' nations, joined once and stored. A build evaluates the features many
    times, and a join in each would send all customers through the driver as often."""

    def make():
        orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
        customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey").hint("merge")
        joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        return materialise(joined.select("o_orderkey", "o_totalprice", "c_nationkey"))

    return shared("orders of nations", spark, sf_dir, make)


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The features with their box as a struct."""
    rows = spark.sql(FEATURES_SQL.replace(JOINED, "{joined}"), joined=orders_of_nations(spark, sf_dir))
    return rows.withColumn("bbox", boxes.box(*(F.col(s) for s in boxes.SIDES))).drop(*boxes.SIDES)


def shaped_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The features as a source layer: attributes and a binary shape, without a box."""
    sides = [F.col(f"bbox.{s}") for s in boxes.SIDES]
    return (
        features(spark, sf_dir)
        .withColumn("geometry", wkb.rectangle_column(*sides))
        .drop("bbox", "wkb_bytes")
    )


def ringed_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The features with shapes of the size that published boundaries have, some 3 KB of several rings."""
    sides = [F.col(f"bbox.{s}") for s in boxes.SIDES]
    return features(spark, sf_dir).withColumn("geometry", wkb.ringed_column(*sides)).drop("bbox", "wkb_bytes")
