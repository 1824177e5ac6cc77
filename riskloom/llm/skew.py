"""Joins of many rows with a table of one row per key, where a few keys may hold much of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key with more than this share of the rows is spread; so fewer than SPREAD keys are, each over as many salts.
SPREAD = 64


def join_spread(rows: DataFrame, table: DataFrame, keys: list[str], spread_by: Column, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``table`` (one row per key) on ``keys``, which both have and hold no nulls.

    Keys with over 1/SPREAD of the rows are fewer than SPREAD, so the driver may see them; their rows are dealt
    over SPREAD salts by a hash of ``spread_by``, and their one row of ``table`` is repeated for each salt.
    ``rows`` is counted first, so it should be cheap to read again.
    """
    counts = rows.groupBy(*keys).agg(F.count("*").alias("_n"))
    total = rows.count()
    heavy = counts.where(F.col("_n") * SPREAD > F.lit(total)).select(*keys).collect()
    if not heavy:
        return rows.join(table, keys, how)
    hot = reduce(lambda a, b: a | b, (reduce(lambda a, b: a & b, (F.col(k) == F.lit(r[k]) for k in keys)) for r in heavy))
    salted = rows.withColumn("_salt", F.when(hot, F.pmod(F.xxhash64(spread_by), F.lit(SPREAD)).cast("int")).otherwise(0))
    copies = table.withColumn("_salt", F.explode(F.when(hot, F.sequence(F.lit(0), F.lit(SPREAD - 1))).otherwise(F.array(F.lit(0)))))
    return salted.join(copies, [*keys, "_salt"], how).drop("_salt")
