"""Global order statistics without a single-partition window.

``Window.orderBy(...)`` with no ``partitionBy`` moves every row into one task. Here the
rows are range-partitioned on the full sort key (the key is part of the order, so one
hot score value is split across partitions by key), sorted inside each partition, and
frozen with a reliable checkpoint so partition ids and in-partition indexes are the
same in every later job, also after an executor is lost. Per-partition counts (one row
per partition, so at most as many rows as the session's shuffle partitions) give each
partition its offset; position = offset + index in partition.

Quantiles first collapse the rows to (value, count): a value shared by a third of the rows
is one row, the sort key is unique, and so a range shuffle run again after a lost executor
deals the same rows to the same ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import ensure_checkpoint_dir


def freeze_ordered(df: DataFrame, order: Sequence[Column], num_partitions: int | None = None) -> DataFrame:
    """Range-partition + sort on ``order``; add ``_pid`` and ``_idx`` (index in partition); checkpoint.

    ``order`` should be total (end it with a unique key, or collapse equal rows first): then
    equal values are cut into many ranges, and the ranges are the same on every run.
    """
    # Without an explicit count, AQE coalesces adjacent ranges to its advisory partition
    # size (contiguous ranges, so the order is kept): few partitions for small inputs,
    # ~advisory-sized ones at scale; never more than spark.sql.shuffle.partitions.
    ranged = df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order)
    ordered = ranged.sortWithinPartitions(*order)
    tagged = ordered.withColumns({
        "_pid": F.spark_partition_id(),
        "_mid": F.monotonically_increasing_id(),
    })
    tagged = tagged.withColumn("_idx", F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)).drop("_mid")
    ensure_checkpoint_dir(df.sparkSession)
    return tagged.checkpoint(eager=True)


def _offsets(frozen: DataFrame, value_cols: Sequence[str] = ()) -> DataFrame:
    """One row per partition: exclusive prefix of counts (and of ``value_cols``) over partitions."""
    aggs = [F.count(F.lit(1)).alias("_cnt")] + [F.sum(c).alias(f"_s_{c}") for c in value_cols]
    per_part = frozen.groupBy("_pid").agg(*aggs)
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    cols = {
        "_off": F.coalesce(F.sum("_cnt").over(before), F.lit(0)).cast("long"),
        "_n": F.sum("_cnt").over(everything).cast("long"),
    }
    for c in value_cols:
        cols[f"_off_{c}"] = F.coalesce(F.sum(f"_s_{c}").over(before), F.lit(0))
        cols[f"_tot_{c}"] = F.sum(f"_s_{c}").over(everything)
    return per_part.select("_pid", *[v.alias(k) for k, v in cols.items()])


def with_positions(df: DataFrame, order: Sequence[Column], pos_col: str = "pos", n_col: str = "n_total",
                   num_partitions: int | None = None) -> DataFrame:
    """Add the 0-based position of each row in ``order`` and the total row count.

    ``order`` must be a total order (end it with a unique key) for the result to be
    deterministic.
    """
    frozen = freeze_ordered(df, order, num_partitions)
    joined = frozen.join(F.broadcast(_offsets(frozen)), "_pid")  # a row per range: at most the shuffle partitions
    return joined.withColumn(pos_col, F.col("_off") + F.col("_idx")).withColumnRenamed("_n", n_col).drop(
        "_pid", "_idx", "_off"
    )


def ntile_from_position(pos: Column | str, n: Column | str, k: int) -> Column:
    """The tile (1..k) that SQL NTILE(k) gives the row at 0-based ``pos`` of ``n`` rows.

    With n = q*k + r, the first r tiles hold q+1 rows and the rest q.
    """
    pos = F.col(pos) if isinstance(pos, str) else pos
    n = F.col(n) if isinstance(n, str) else n
    q = F.floor(n / F.lit(k))
    r = n - q * F.lit(k)
    big = r * (q + 1)
    return F.when(pos < big, F.floor(pos / (q + 1)) + 1).otherwise(
        r + F.floor((pos - big) / q) + 1
    ).cast("int")


def with_ntile(df: DataFrame, order: Sequence[Column], k: int, tile_col: str = "tile",
               num_partitions: int | None = None) -> DataFrame:
    """WIN-1: NTILE(k) over a global order."""
    ranked = with_positions(df, order, "_pos", "_n", num_partitions)
    return ranked.withColumn(tile_col, ntile_from_position("_pos", "_n", k)).drop("_pos", "_n")


def with_prefix_sums(df: DataFrame, order: Sequence[Column], value_cols: Sequence[str],
                     prefix: str = "cum_", total_prefix: str = "total_",
                     num_partitions: int | None = None) -> DataFrame:
    """Inclusive running sums of ``value_cols`` in a global order, plus column totals.

    Partition totals are prefixed across partitions (tiny table, broadcast); inside a
    partition the running sum is a window partitioned by the partition id.
    """
    frozen = freeze_ordered(df, order, num_partitions)
    offsets = _offsets(frozen, value_cols)
    inside = Window.partitionBy("_pid").orderBy("_idx").rowsBetween(Window.unboundedPreceding, 0)
    running = frozen.withColumns({f"_run_{c}": F.sum(c).over(inside) for c in value_cols})
    joined = running.join(F.broadcast(offsets), "_pid")  # a row per range: at most the shuffle partitions
    out = joined.withColumns({
        **{f"{prefix}{c}": F.col(f"_off_{c}") + F.col(f"_run_{c}") for c in value_cols},
        **{f"{total_prefix}{c}": F.col(f"_tot_{c}") for c in value_cols},
    })
    drop = ["_pid", "_idx", "_cnt", "_off", "_n"] + [
        f"_{k}_{c}" for c in value_cols for k in ("run", "off", "tot", "s")
    ]
    return out.drop(*drop)


def freeze_counts(df: DataFrame, group_cols: Sequence[str], value_col: str, counts: dict[str, Column],
                  num_partitions: int | None = None) -> DataFrame:
    """Collapse to one row per (group, ``value_col``) with the aggregates ``counts``, frozen in that order.

    The value becomes a double; NULL and NaN values and NULL groups are dropped. Counting
    combines map-side, so a hot value is one row per map task, and all later steps
    (cut points, bins, bucket totals) read this table instead of the rows.
    """
    g = list(group_cols)
    v = F.col(value_col).cast("double")
    rows = df.where(v.isNotNull() & ~F.isnan(v))
    for c in g:
        rows = rows.where(F.col(c).isNotNull())
    table = rows.groupBy(*g, v.alias(value_col)).agg(*[e.alias(k) for k, e in counts.items()])
    return freeze_ordered(table, [*[F.col(c).asc() for c in g], F.col(value_col).asc()], num_partitions)


def quantiles_of_counts(frozen: DataFrame, group_cols: Sequence[str], value_col: str, count_col: str,
                        probs: Sequence[float], out_col: str = "cuts") -> DataFrame:
    """Exact quantiles (linear interpolation) per group from a ``freeze_counts`` table.

    Row totals per (range, group) give each its offset; only ranges that hold a wanted order
    statistic (at most two per probability and group) go on to running counts. Output: one
    row per group, ``out_col`` = array of len(probs) doubles. Groups without rows are absent.
    """
    g = list(group_cols)
    held = frozen.where(F.col(count_col) > 0)
    per = held.groupBy("_pid", *g).agg(F.sum(count_col).alias("_c"))
    before = Window.partitionBy(*g).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("_pid", *g, "_c", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"),
                     F.sum("_c").over(Window.partitionBy(*g)).alias("_gn"))

    def wanted(n: Column) -> Column:
        """(probability's index, lower position, upper position, fraction between them)."""
        parts = []
        for j, p in enumerate(probs):
            h = (n - 1) * F.lit(float(p))
            lo = F.floor(h)
            parts.append(F.struct(F.lit(j).alias("j"), lo.alias("lo"), F.least(lo + 1, n - 1).alias("hi"),
                                  (h - lo).alias("frac")))
        return F.array(*parts)

    def inside(at: Column, first: Column, size: Column) -> Column:
        return (at >= first) & (at < first + size)

    def hits(first: Column, size: Column):
        return lambda w: inside(w["lo"], first, size) | inside(w["hi"], first, size)

    off, size = F.col("_off"), F.col("_c")
    per = per.withColumn("_w", F.filter(wanted(F.col("_gn")), hits(off, size))).where(F.size("_w") > 0).drop("_c")
    run = Window.partitionBy("_pid", *g).orderBy(value_col).rowsBetween(Window.unboundedPreceding, -1)
    placed = held.select("_pid", *g, value_col, F.col(count_col).alias("_k")).join(per, ["_pid", *g]).withColumn(
        "_at", off + F.coalesce(F.sum("_k").over(run), F.lit(0)))
    at, k = F.col("_at"), F.col("_k")
    picked = placed.select(*g, value_col, at, k, F.explode(F.filter("_w", hits(at, k))).alias("_w"))
    per_prob = picked.groupBy(*g, F.col("_w.j").alias("_j")).agg(
        F.max("_w.frac").alias("_frac"),
        F.max(F.when(inside(F.col("_w.lo"), at, k), F.col(value_col))).alias("_a"),
        F.max(F.when(inside(F.col("_w.hi"), at, k), F.col(value_col))).alias("_b"),
    )
    q = F.when(F.col("_frac") == 0, F.col("_a")).otherwise(F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_frac"))
    listed = F.array_sort(F.collect_list(F.struct("_j", q.alias("_q"))))
    return per_prob.groupBy(*g).agg(F.transform(listed, lambda s: s["_q"]).alias(out_col))


def exact_quantiles(df: DataFrame, column: str, probs: Sequence[float],
                    num_partitions: int | None = None) -> list[float | None]:
    """AGG-9: exact quantiles with linear interpolation (numpy/DuckDB ``quantile_cont``).

    NULL and NaN are ignored; without any value every quantile is None. Only the result
    reaches the driver; counting and sorting are distributed.
    """
    frozen = freeze_counts(df, [], column, {"_n": F.count(F.lit(1))}, num_partitions)
    cuts = quantiles_of_counts(frozen, [], column, "_n", probs).first()["cuts"]
    return cuts or [None for _ in probs]


def grouped_quantiles(df: DataFrame, group_cols: Sequence[str], value_col: str, probs: Sequence[float],
                      out_col: str = "cuts", num_partitions: int | None = None) -> DataFrame:
    """Exact quantiles of ``value_col`` per group, one row per group, all groups in one pass."""
    frozen = freeze_counts(df, group_cols, value_col, {"_n": F.count(F.lit(1))}, num_partitions)
    return quantiles_of_counts(frozen, group_cols, value_col, "_n", probs, out_col)
