"""Data-contract validation (GOV-1) in one pass.

Each rule becomes a ``count_if`` predicate; all of them run in a single aggregate
(partial per partition, one tiny merge), then the one-row result is unpivoted to
(field, rule, violations). The primary-key check is a separate group-by on the key
(partial aggregation first, so a hot duplicated key costs one counter per partition).

Rule choices: a NULL in a non-required field passes min/max/allowed; a type violation
is text present whose ``try_cast`` is NULL; min and max are inclusive.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.sources.policy import CONTRACT_FIELDS, CONTRACT_PRIMARY_KEY

SPARK_TYPES = {"string": "string", "date": "date", "float": "double", "integer": "int", "category": "string"}


def rule_predicates(df: DataFrame, fields: Sequence[tuple] = CONTRACT_FIELDS) -> list[tuple[str, str, Column]]:
    """(field, rule, violation predicate) for every rule that applies to a present column."""
    types = dict(df.dtypes)
    out: list[tuple[str, str, Column]] = []
    for name, ftype, required, lo, hi, allowed, fmt in fields:
        if name not in types:
            out.append((name, "missing_column", F.lit(True)))
            continue
        c = F.col(name)
        if required:
            out.append((name, "required", c.isNull()))
        target = SPARK_TYPES[ftype]
        typed = c
        if types[name] == "string" and target != "string":
            if ftype == "date" and fmt:
                typed = F.try_to_timestamp(c, F.lit(fmt)).cast("date")
                out.append((name, "format", c.isNotNull() & typed.isNull()))
            else:
                typed = c.try_cast(target)
                out.append((name, "type", c.isNotNull() & typed.isNull()))
        if lo is not None:
            out.append((name, "min", typed < F.lit(lo)))
        if hi is not None:
            out.append((name, "max", typed > F.lit(hi)))
        if allowed is not None:
            out.append((name, "allowed", typed.isNotNull() & ~typed.isin(list(allowed))))
    return out


def validate(df: DataFrame, fields: Sequence[tuple] = CONTRACT_FIELDS) -> DataFrame:
    """(field, rule, violations, n_rows) for every rule, from one aggregate."""
    preds = rule_predicates(df, fields)
    aggs = [F.count(F.lit(1)).alias("n_rows")] + [
        F.count_if(p).alias(f"v{i}") for i, (_, _, p) in enumerate(preds)
    ]
    one = df.agg(*aggs)
    entries = F.array(*[
        F.struct(F.lit(f).alias("field"), F.lit(r).alias("rule"), F.col(f"v{i}").cast("long").alias("violations"))
        for i, (f, r, _) in enumerate(preds)
    ])
    return one.select("n_rows", F.explode(entries).alias("_r")).select(
        "_r.field", "_r.rule", "_r.violations", F.col("n_rows").cast("long").alias("n_rows")
    )


def duplicate_keys(df: DataFrame, key: str = CONTRACT_PRIMARY_KEY) -> DataFrame:
    """Keys that occur more than once: (key, n)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def key_summary(df: DataFrame, key: str = CONTRACT_PRIMARY_KEY) -> DataFrame:
    """One row: null keys, duplicated keys, rows sharing a duplicated key."""
    per = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(
        F.sum(F.when(F.col(key).isNull(), F.col("n")).otherwise(0)).cast("long").alias("null_keys"),
        F.count_if(F.col(key).isNotNull() & (F.col("n") > 1)).cast("long").alias("duplicated_keys"),
        F.sum(F.when(F.col(key).isNotNull() & (F.col("n") > 1), F.col("n")).otherwise(0)).cast("long").alias("rows_with_duplicated_key"),
    )


def with_violations(df: DataFrame, fields: Sequence[tuple] = CONTRACT_FIELDS, col: str = "violations") -> DataFrame:
    """GOV-1: every row with the array of (field, rule) that it breaks, empty for a clean row; one projection."""
    hits = F.array(*[
        F.when(F.coalesce(p, F.lit(False)), F.struct(F.lit(f).alias("field"), F.lit(r).alias("rule"))) for f, r, p in rule_predicates(df, fields)
    ])
    return df.withColumn(col, F.filter(hits, lambda x: x.isNotNull()))


def write_split(df: DataFrame, folder: str, fields: Sequence[tuple] = CONTRACT_FIELDS) -> tuple[DataFrame, DataFrame]:
    """GOV-1: clean rows and broken rows written in one pass (``folder``/clean=true|false); returns (clean rows, violations table).

    The violations table has a row per broken rule: field, rule, and the columns of the row. ``df`` should not have columns named
    ``violations`` or ``clean``.
    """
    out = with_violations(df, fields).withColumn("clean", F.size("violations") == 0)
    out.write.partitionBy("clean").parquet(folder)
    back = df.sparkSession.read.schema(out.schema).parquet(folder)
    clean = back.where("clean").select(*df.columns)
    broken = back.where(~F.col("clean")).select(F.explode("violations").alias("_v"), *df.columns)
    return clean, broken.select("_v.field", "_v.rule", *df.columns)
