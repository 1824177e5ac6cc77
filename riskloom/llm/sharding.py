"""Sharding by weighted rendezvous hashing of a stable record key.

Shard s with weight w scores a key with -ln(u) / w, u a hash of (s, key) in (0, 1); the least score wins. A
key's scores for the old shards do not change when a shard is added, so only rows that the new
one wins move. Choosing a shard is a column expression: no shuffle, no table of keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.session import ensure_checkpoint_dir

SHARDS = 24


def rendezvous(key: Column, weights: list[float]) -> Column:
    """The shard (0..) of a key; equal scores go to the lower shard, null keys all to one shard."""

    def score(s: int) -> Column:
        u = (F.shiftrightunsigned(F.xxhash64(F.lit(s), key), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
        return F.struct((-F.ln(u) / F.lit(float(weights[s]))).alias("score"), F.lit(s).alias("shard"))

    if len(weights) == 1:
        return F.lit(0)
    return F.least(*[score(s) for s in range(len(weights))])["shard"]


def shard(rows: DataFrame, key: str, weights: list[float], order: list[str]) -> DataFrame:
    """``rows`` with ``shard``, ``grown_shard`` (with one more shard of mean weight) and ``slot``, gapless from 0 in a shard.

    Slots follow (key, *order). Rows are frozen in ranges of that order, counted per (range, shard), and numbered
    from the running total of the ranges before: no task holds a shard.

    Defined cases: null keys share the shard that the hash of null wins, first in the order; rows of one key
    share a shard and have slots next to each other (rows equal in key and order in any order); an empty table
    gives an empty one; columns named like a result are replaced.
    """
    ensure_checkpoint_dir(rows.sparkSession)
    by = [F.col(c) for c in (key, *order)]
    names = [c for c in rows.columns if c not in ("shard", "grown_shard", "slot")]
    chosen = rows.select(*names, rendezvous(F.col(key), weights).alias("shard"),
                         rendezvous(F.col(key), [*weights, sum(weights) / len(weights)]).alias("grown_shard"))
    frozen = chosen.repartitionByRange(*by).withColumn("_range", F.spark_partition_id()).checkpoint()
    counts = frozen.groupBy("_range", "shard").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(W.partitionBy("shard").orderBy("_range").rowsBetween(W.unboundedPreceding, -1))
    starts = counts.select("_range", "shard", F.coalesce(before, F.lit(0)).alias("_start"))
    nth = F.row_number().over(W.partitionBy("_range", "shard").orderBy(*by)) - 1
    out = frozen.withColumn("_nth", nth).join(starts, ["_range", "shard"])
    return out.select(*names, "shard", "grown_shard", (F.col("_nth") + F.col("_start")).cast("long").alias("slot"))


def op3_rendezvous(spark, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of equal weight; the key law."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.lit("key").alias("law")
    )
    return shard(rows, "doc_id", [1.0] * SHARDS, ["text_crc32", "size"])
