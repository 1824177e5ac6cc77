"""Feature engineering (FE-1..12) and linear attributions (GOV-6).

Fit/transform follows the spark.ml pattern, so fitting on train and applying to validation
never refits. Scalers keep one mean and sd per column as literals. Encoders keep their levels
as a table that is joined back (the planner chooses how), so the number of levels is unbounded.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators import ranks


def round_param(x: float | None, digits: int | None) -> float | None:
    """Fitted parameter to ``digits`` significant digits; None keeps it as it is.

    The last bits of a distributed mean depend on the order of addition (partitioning,
    engine); a caller that needs the same transform everywhere asks for fewer digits.
    """
    if digits is None or x is None or x == 0 or x != x:
        return x
    return round(x, digits - 1 - math.floor(math.log10(abs(x))))


def frequency_index_table(df: DataFrame, col: str, index_col: str = "index") -> DataFrame:
    """FE-2/FE-4: (level, n, index) with index 0 = most frequent, ties by label (StringIndexer order).

    Counting is a partial + final aggregate; the ranking of the distinct levels uses the
    distributed positions of ``ranks`` (not a one-task window), so a high-cardinality
    column does not pile into one task.
    """
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    ranked = ranks.with_positions(counts, [F.col("n").desc(), F.col(col).asc_nulls_first()], "_pos", "_n")
    return ranked.select(col, "n", F.col("_pos").cast("int").alias(index_col))


class FrequencyIndexer:
    """FE-2/FE-3: StringIndexer order (frequency desc, label asc); NULL and unseen levels -> K ('keep')."""

    def __init__(self, column: str, output: str | None = None):
        self.column = column
        self.output = output or f"{column}_index"
        self.table: DataFrame | None = None
        self.size = 0

    def fit(self, df: DataFrame) -> "FrequencyIndexer":
        table = frequency_index_table(df.where(F.col(self.column).isNotNull()), self.column, "_index")
        self.table = table.select(F.col(self.column).alias("_level"), "_index")
        self.size = self.table.count()
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        joined = df.join(self.table, F.col(self.column) == F.col("_level"), "left")
        return joined.withColumn(self.output, F.coalesce("_index", F.lit(self.size)).cast("int")).drop("_level", "_index")


class CategoryEncoder:
    """FE-6: alphabetical level index per column (NULL and unseen -> K), one-hot columns or sparse vectors on demand.

    ``table`` holds (feature, level, index), one row per level; ``sizes`` the number of levels K per column.
    """

    def __init__(self, columns: Sequence[str]):
        self.columns = list(columns)
        self.table: DataFrame | None = None
        self.sizes: dict[str, int] = {}

    def fit(self, df: DataFrame) -> "CategoryEncoder":
        """One distributed distinct over all columns; indexes are positions in (feature, level) order."""
        stacked = df.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("level")) for c in self.columns
        ])).alias("_x")).select("_x.*").where(F.col("level").isNotNull()).distinct()
        placed = ranks.with_positions(stacked, [F.col("feature").asc(), F.col("level").asc()], "_pos", "_n").drop("_n")
        first = placed.groupBy("feature").agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_k")).collect()  # a row per column
        start = {r["feature"]: r["_first"] for r in first}
        self.sizes = {c: 0 for c in self.columns} | {r["feature"]: r["_k"] for r in first}
        before = F.coalesce(*[F.when(F.col("feature") == c, F.lit(n)) for c, n in start.items()], F.lit(0))
        self.table = placed.select("feature", "level", (F.col("_pos") - before).cast("int").alias("index"))
        return self

    def transform_index(self, df: DataFrame) -> DataFrame:
        for c in self.columns:
            levels = self.table.where(F.col("feature") == c).select(F.col("level").alias("_level"), F.col("index").alias("_index"))
            df = df.join(levels, F.col(c).cast("string") == F.col("_level"), "left").withColumn(
                f"{c}_idx", F.coalesce("_index", F.lit(self.sizes[c])).cast("int")).drop("_level", "_index")
        return df

    def transform_vector(self, df: DataFrame) -> DataFrame:
        """The indexes of ``transform_index``, and per column that has levels a sparse vector ``<col>_vec`` of length K;
        an unseen level is all zeros. spark.ml keeps an attribute per level in the column's metadata, which is slow for
        tens of thousands of levels; ``transform_index`` has no such part."""
        from pyspark.ml.feature import OneHotEncoder

        cols = [c for c in self.columns if self.sizes[c]]
        sizes = self.table.select(*[
            F.when(F.col("feature") == c, F.col("index")).otherwise(0).alias(f"{c}_idx") for c in cols])
        # the extra category of 'keep' holds index K and is the one dropped
        encoder = OneHotEncoder(inputCols=[f"{c}_idx" for c in cols], outputCols=[f"{c}_vec" for c in cols], handleInvalid="keep")
        return encoder.fit(sizes).transform(self.transform_index(df))

    def level_names(self) -> dict[str, list[str]]:
        """The levels per column on the driver: for named one-hot columns, where each level is part of the schema."""
        rows = self.table.orderBy("feature", "index").collect()
        return {c: [r["level"] for r in rows if r["feature"] == c] for c in self.columns}

    def transform_onehot(self, df: DataFrame) -> DataFrame:
        """One 0/1 column per seen level (``<col>_<level>``); an unseen level is all zeros.
        The schema grows with the levels; ``transform_vector`` is the form for many of them."""
        return df.withColumns({
            f"{c}_{v}": F.coalesce((F.col(c) == F.lit(v)).cast("double"), F.lit(0.0))
            for c, levels in self.level_names().items() for v in levels})

    def output_names(self) -> list[str]:
        return [f"{c}_{v}" for c, levels in self.level_names().items() for v in levels]


class Standardizer:
    """FE-7: (x - mean) / population sd; a zero or undefined sd becomes 1."""

    def __init__(self, columns: Sequence[str], suffix: str = "_z", digits: int | None = None):
        self.columns = list(columns)
        self.suffix = suffix
        self.digits = digits
        self.mean: dict[str, float] = {}
        self.sd: dict[str, float] = {}

    def fit(self, df: DataFrame) -> "Standardizer":
        aggs = []
        for c in self.columns:
            aggs += [F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}")]
        row = df.agg(*aggs).first()
        for c in self.columns:
            mean, sd = round_param(row[f"m_{c}"], self.digits), round_param(row[f"s_{c}"], self.digits)
            self.mean[c] = mean
            self.sd[c] = 1.0 if sd is None or sd == 0 else sd
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({
            f"{c}{self.suffix}": (F.col(c) - F.lit(self.mean[c])) / F.lit(self.sd[c]) for c in self.columns
        })


def leakage_report(df: DataFrame, features: Sequence[str], label: str, threshold: float = 0.99) -> DataFrame:
    """FE-12: (feature, corr_with_label, leak) from one aggregate over all features."""
    one = df.agg(*[F.corr(F.col(c).cast("double"), F.col(label).cast("double")).alias(c) for c in features])
    rows = one.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).alias("r")) for c in features
    ])).alias("_x"))
    return rows.select(
        F.col("_x.feature").alias("feature"),
        F.round("_x.r", 6).alias("corr_with_label"),
        F.coalesce(F.abs("_x.r") >= F.lit(threshold), F.lit(False)).alias("leak"),
    )


def feature_manifest(train: DataFrame, categorical: Sequence[str], numeric: Sequence[str],
                     passthrough: Sequence[str]) -> DataFrame:
    """FE-9/FE-10: (position, name, source, kind): one-hot levels, then numeric, then pass-through."""
    enc = CategoryEncoder(categorical).fit(train)
    start, at = {}, 0
    for c in categorical:
        start[c], at = at, at + enc.sizes[c]
    before = F.coalesce(*[F.when(F.col("feature") == c, F.lit(n)) for c, n in start.items()], F.lit(0))
    levels = enc.table.select(
        (F.col("index") + before).cast("int").alias("position"), F.concat_ws("_", "feature", "level").alias("name"),
        F.col("feature").alias("source"), F.lit("onehot").alias("kind"))
    rest = [(c, c, "numeric") for c in numeric] + [(c, c, "passthrough") for c in passthrough]
    return levels.unionByName(train.sparkSession.createDataFrame(
        [(at + i, *r) for i, r in enumerate(rest)], "position int, name string, source string, kind string"))


def assemble(df: DataFrame, inputs: Sequence[str], output: str = "features", handle_invalid: str = "keep") -> DataFrame:
    """FE-1: spark.ml VectorAssembler with an explicit NULL policy (``skip`` drops, ``keep`` -> NaN)."""
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=list(inputs), outputCol=output, handleInvalid=handle_invalid).transform(df)


class LinearAttribution:
    """GOV-6: contribution of feature f = coef_f * (x_f - mean_f) (exact SHAP for a linear
    model with independent features); means from the training data."""

    def __init__(self, coefficients: dict[str, float], digits: int | None = None):
        self.coefficients = dict(coefficients)
        self.digits = digits
        self.mean: dict[str, float] = {}

    def fit(self, df: DataFrame) -> "LinearAttribution":
        row = df.agg(*[F.avg(c).alias(c) for c in self.coefficients]).first()
        self.mean = {c: round_param(row[c], self.digits) for c in self.coefficients}
        return self

    def contribution(self, c: str):
        return F.lit(float(self.coefficients[c])) * (F.col(c) - F.lit(self.mean[c]))

    def global_importance(self, df: DataFrame) -> DataFrame:
        """(feature, mean_abs_contribution) from one aggregate."""
        one = df.agg(*[F.avg(F.abs(self.contribution(c))).alias(c) for c in self.coefficients])
        return one.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("feature"), F.round(F.col(c), 9).alias("mean_abs_contribution"))
            for c in self.coefficients
        ])).alias("_x")).select("_x.*")

    def top(self, k: int = 2):
        """Array of (neg, feature, contribution): the k largest contributions of a row, equal ones by feature."""
        entries = F.array(*[
            F.struct((-self.contribution(c)).alias("neg"), F.lit(c).alias("feature"),
                     self.contribution(c).alias("contribution"))
            for c in self.coefficients
        ])
        return F.slice(F.sort_array(entries), 1, k)

    def top_reasons(self, df: DataFrame, key: str, k: int = 2) -> DataFrame:
        """(key, rank, feature, contribution) of the k largest contributions per row.

        The ranking is a sort of a fixed-length array inside each row: no shuffle.
        """
        top = df.select(key, self.top(k).alias("_top"))
        return top.select(key, F.posexplode("_top").alias("_r", "_e")).select(
            key, (F.col("_r") + 1).cast("int").alias("rank"), F.col("_e.feature").alias("feature"),
            F.col("_e.contribution").alias("contribution"),
        )
