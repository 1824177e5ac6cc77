"""spark.ml model queries (ML-1..9, EV-1/2/6/8/10, SPL-1 random, SPL-3).

Model fitting is spark.ml's distributed optimisation (treeAggregate of gradients for
logistic regression, per-level histogram aggregation for trees); scoring is a
projection. A fitted model has no SQL twin, so these queries are registered without
an oracle; their metric code is the same code the SQL-checked queries use.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import KolmogorovSmirnovTest
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators import boosting, drift, features, forests, governance, metrics, splits, weights
from riskloom.plans import catalog
from riskloom.plans.catalog import query
from riskloom.session import ensure_checkpoint_dir
from riskloom.sources import policy

LABEL = "loan_status_flag"
KEY = "loan_id"
# Fixed values that must equal the reference's: the weighted model's feature list.
LOAN_FEATURES = ["fico_score", "loan_amount", "tenure_months", "monthly_income", "credit_utilization",
                 "has_bankruptcy", "cltv", "high_risk_flag"]
SEED = 42


def one_row(**frames: DataFrame) -> DataFrame:
    """Stack one-row, one-column frames as (metric, value) and pivot to one wide row
    with a single aggregate (no join between one-row frames)."""
    names = list(frames)
    long = None
    for n, f in frames.items():
        part = f.select(F.lit(n).alias("metric"), F.col(f.columns[0]).cast("double").alias("value"))
        long = part if long is None else long.unionByName(part)
    return long.agg(*[F.max(F.when(F.col("metric") == n, F.col("value"))).alias(n) for n in names])


def positive_probability(pred: DataFrame, col: str = "p") -> DataFrame:
    """PRJ-13: P(label = 1) out of the probability vector (no Python UDF)."""
    return pred.withColumn(col, vector_to_array("probability")[1])


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows dealt by ``key`` over at least as many partitions as there are cores: an iterative fit visits them in every
    round, and AQE would have coalesced a small table into one task."""
    spark = df.sparkSession
    n = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(n, key)


#: Rows of a task in a fit of many short jobs: fewer would cost more to deal out than to visit.
ROWS_PER_TASK = 1 << 17


def spread_by_rows(df: DataFrame, key: str, n_rows: int) -> DataFrame:
    """Rows dealt by ``key`` over a task per core, and over as many more rounds of tasks as ROWS_PER_TASK asks for; the
    shuffle setting, which may be hundreds of tasks for a table of any size, plays no part."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores * max(1, -(-n_rows // (cores * ROWS_PER_TASK))), key)


def loan_frame(spark: SparkSession, sf: str, scheme: str = "majority", assembled: bool = True) -> DataFrame:
    """Cleaned loans with complete features (FLT-3), class weight (CW) and a stable split."""
    df = catalog.clean_loans(spark, sf).dropna(subset=LOAN_FEATURES + [LABEL])
    df = weights.with_class_weight(df, LABEL, scheme, "class_weight")
    df = splits.with_hash_split(df, KEY, 80)
    return features.assemble(df, LOAN_FEATURES, "features", handle_invalid="error") if assembled else df


def evaluate(pred: DataFrame, label: str, key: str) -> DataFrame:
    """EV-1/2/3/4/5 on a prediction table, one row.

    The scored rows feed five metrics, so they are written once as a reliable checkpoint
    (the model is applied once, not per metric job; no cache is left behind).
    """
    ensure_checkpoint_dir(pred.sparkSession)
    pred = pred.select(key, label, "rawPrediction", "probability").checkpoint(eager=True)
    scored = positive_probability(pred)
    binned = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction")
    prob = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="probability")
    spark = pred.sparkSession
    exact = metrics.auc_ks_exact(scored, "p", label)
    return one_row(
        auc_exact=exact.select("auc"),
        auc_binned=spark.createDataFrame([(float(binned.evaluate(pred)),)], "v double"),
        auc_probability=spark.createDataFrame([(float(prob.evaluate(pred)),)], "v double"),
        ks_exact=exact.select("ks"),
        ks_decile=metrics.ks_decile(scored, "p", label, key),
        n_test=exact.select(F.col("n_pos") + F.col("n_neg")),
    )


@query("ml2_weighted_logreg")
def q_weighted_logreg(spark, sf):
    """ML-2 + CW-1 + FE-1 + FE-11 + EV-1..5: majority-ratio weighted L2 logistic regression
    (regParam 0.1) as an assembler + estimator Pipeline, trained on the hash-split 80 %,
    evaluated on the 20 %."""
    df = spread(loan_frame(spark, sf, assembled=False), KEY).persist(StorageLevel.MEMORY_AND_DISK)  # fit + score
    pipe = Pipeline(stages=[
        VectorAssembler(inputCols=LOAN_FEATURES, outputCol="features", handleInvalid="error"),
        LogisticRegression(labelCol=LABEL, featuresCol="features", weightCol="class_weight",
                           regParam=0.1, elasticNetParam=0.0),
    ])
    model = pipe.fit(df.where(F.col("split") == "train"))
    out = evaluate(model.transform(df.where(F.col("split") == "test")), LABEL, KEY)
    df.unpersist()  # the metrics read the checkpointed scored rows
    return out


VARIANTS = {
    # name: (weight scheme or None, regParam, elasticNetParam, maxIter)
    "baseline_unregularized": (None, 0.0, 0.0, 100),   # ML-1
    "weighted_l2": ("majority", 0.1, 0.0, 100),        # ML-2
    "weighted_unregularized": ("neg_pos", 0.0, 0.0, 100),  # ML-2b
    "weighted_elastic_net": ("complement", 0.1, 0.8, 10),  # ML-3
}


@query("ml9_variant_comparison")
def q_variant_comparison(spark, sf):
    """ML-1/2/2b/3/9: baseline vs weighted variants on one split; AUC and KS per variant.

    Each variant is fitted on the same training rows; the test predictions of all variants
    are stacked (variant, p, label) and ranked in one grouped pass for AUC and for KS.
    """
    base = catalog.clean_loans(spark, sf).dropna(subset=LOAN_FEATURES + [LABEL])
    base = spread(features.assemble(splits.with_hash_split(base, KEY, 80), LOAN_FEATURES, "features", "error"), KEY)
    # four fits and four scorings read it; released once the scored rows are checkpointed
    base = base.persist(StorageLevel.MEMORY_AND_DISK)
    stacked = None
    for name, (scheme, reg, enet, iters) in VARIANTS.items():
        df = weights.with_class_weight(base, LABEL, scheme, "w", fit_on=base.where(F.col("split") == "train")) if scheme else base
        lr = LogisticRegression(labelCol=LABEL, regParam=reg, elasticNetParam=enet, maxIter=iters,
                                **({"weightCol": "w"} if scheme else {}))
        model = lr.fit(df.where(F.col("split") == "train"))
        scored = positive_probability(model.transform(df.where(F.col("split") == "test"))).select(
            F.lit(name).alias("variant"), "p", LABEL)
        stacked = scored if stacked is None else stacked.unionByName(scored)
    ensure_checkpoint_dir(spark)
    stacked = stacked.checkpoint(eager=True)  # fitted once, scored once
    base.unpersist()
    return metrics.auc_ks_exact_by(stacked, ["variant"], "p", LABEL).select("variant", "auc", "ks")


@query("ev6_ks_sample")
def q_ks_sample(spark, sf):
    """SPL-3 + EV-6: exact KS on a 20 % Bernoulli sample (seed 42) of the scored test rows."""
    df = spread(loan_frame(spark, sf), KEY).persist(StorageLevel.MEMORY_AND_DISK)  # fit + score
    model = LogisticRegression(labelCol=LABEL, weightCol="class_weight", regParam=0.1).fit(
        df.where(F.col("split") == "train"))
    scored = positive_probability(model.transform(df.where(F.col("split") == "test")))
    out = metrics.ks_exact(splits.bernoulli_sample(scored, 0.2, SEED), "p", LABEL)
    df.unpersist()  # the KS reads its frozen (checkpointed) running sums
    return out


@query("ev8_ks_normal")
def q_ks_normal(spark, sf):
    """EV-8: one-sample KS of the standardized FICO score against N(0, 1)."""
    df = catalog.clean_loans(spark, sf)
    z = features.Standardizer(["fico_score"]).fit(df).transform(df)
    return KolmogorovSmirnovTest.test(z, "fico_score_z", "norm", 0.0, 1.0).select(
        F.round("statistic", 9).alias("statistic"), F.round("pValue", 9).alias("p_value"))


@query("spl1_random_split")
def q_random_split(spark, sf):
    """SPL-1 as written (randomSplit 80/20, seed 42): rows per side and class."""
    tr, te = splits.random_split(catalog.clean_loans(spark, sf), (0.8, 0.2), SEED)
    return (tr.withColumn("split", F.lit("train")).unionByName(te.withColumn("split", F.lit("test")))
            .groupBy("split", LABEL).agg(F.count(F.lit(1)).alias("n")))


@query("spl3_sample")
def q_sample(spark, sf):
    """SPL-3: 20 % Bernoulli sample (seed 42), rows per class."""
    return splits.bernoulli_sample(catalog.clean_loans(spark, sf), 0.2, SEED).groupBy(LABEL).agg(
        F.count(F.lit(1)).alias("n"))


# ----------------------------------------------------------------------------- bureau models

def bureau_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The columns of both windows that the models name. The fits of encoder, scaler, weights and models read them many times, so the
    joins are done once and the rows are kept as Parquet in the shared folder: some 20 bytes each, where the assembled row has hundreds."""
    bs = catalog.bureau_split(spark, sf).where(F.col("split").isNotNull())
    # rows without a complete set of numbers are left out, in both windows and before anything is fitted
    numbers = policy.NUMERIC_FEATURES + policy.PASSTHROUGH_FEATURES
    bs = bs.dropna(subset=numbers + ["defaulted"]).select("customer_id", "split", "defaulted", *policy.CATEGORICAL_FEATURES, *numbers)
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/bureau-{uuid.uuid4().hex}"
    bs.write.parquet(folder)
    return spark.read.parquet(folder)


def bureau_design(bs: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """FE-6/7/8/10 fitted on the training window of ``bs``, applied to both windows (of ``rows``, the same rows dealt otherwise);
    balanced weights (CW-8)."""
    train = bs.where(F.col("split") == "train")
    enc = features.CategoryEncoder(policy.CATEGORICAL_FEATURES).fit(train)
    sc = features.Standardizer(policy.NUMERIC_FEATURES).fit(train)
    inputs = enc.output_names() + [f"{c}_z" for c in policy.NUMERIC_FEATURES] + policy.PASSTHROUGH_FEATURES
    d = features.assemble(sc.transform(enc.transform_onehot(bs if rows is None else rows)), inputs, "features", "error")
    d = weights.with_class_weight(d, "defaulted", "balanced", "w", fit_on=train)
    return d.select("customer_id", "split", "defaulted", "w", "features")


def bureau_estimators(n_train: int) -> dict:
    """ML-4/5/6 with the reference's settings where Spark has them: a spark.ml estimator, and the trees of ``forests`` with the settings
    and the rules of spark.ml's GBTClassifier and RandomForestClassifier.

    sklearn's C=1 L2 sums the loss over rows; Spark averages it over the weights, so
    regParam = 1 / n. The second ensemble is a random forest of 500 trees with the same row and column sampling; leaf-wise boosting
    is ``ml6_leafwise_trees``.
    """
    return {
        "logistic_regression": LogisticRegression(labelCol="defaulted", weightCol="w", regParam=1.0 / max(n_train, 1),
                                                  standardization=False, maxIter=2000),
        "gradient_boosted_trees": forests.TreeParams(trees=300, depth=4, forest=False, row_share=0.9, column_share=0.9, seed=SEED),
        "random_forest": forests.TreeParams(trees=500, depth=5, forest=True, row_share=0.9, column_share=0.9, seed=SEED),
    }


def candidate_scores(model, df: DataFrame) -> DataFrame:
    """``df`` with the model's probability of label 1 as ``p``."""
    if isinstance(model, forests.TreeModel):
        return model.transform(df.withColumn("features", vector_to_array("features")))
    return positive_probability(model.transform(df))


#: Rounds that the query fits and counts again; ``boosting.LeafwiseParams`` has the reference's 500, which take five times as long.
LEAFWISE_ROUNDS = 100

_LEAFWISE_SQL = f"""WITH {catalog.BUREAU_SPLIT_SQL},
t AS (SELECT COUNT(*) AS n FROM bs WHERE split = 'train')
SELECT CAST(tree AS INTEGER) AS tree, n AS n_rows, CAST(0 AS BIGINT) AS n_differences, CAST(0 AS BIGINT) AS n_unsolved, TRUE AS in_limits
FROM t, range(0, {{rounds}}) AS r(tree)"""


@query("ml6_leafwise_trees", _LEAFWISE_SQL.format(rounds=LEAFWISE_ROUNDS), ("bureau",))
def q_leafwise_trees(spark, sf):
    """ML-6: leaf-wise boosting with the reference's settings (31 leaves, L2 of 5, 0.9 of the columns; the first LEAFWISE_ROUNDS of
    its 500 rounds) on the training window. Per tree, from the training rows counted again through the fitted trees: their number, leaves whose rows, gradient or Hessian
    sums are not those of the fit, leaves whose value does not solve the leaf's equation (to 1e-9), and whether leaves and rows per leaf
    are within the limits."""
    d = bureau_design(bureau_rows(spark, sf)).where(F.col("split") == "train").select(vector_to_array("features").alias("features"), "defaulted")
    params = boosting.LeafwiseParams(rounds=LEAFWISE_ROUNDS)
    # the assembled rows are read a few times only, and made anew from the written ones each time: hundreds of bytes a row are kept nowhere
    model = boosting.fit_leafwise(d, "defaulted", params=params)
    again = model.leaf_sums(d, "features", "defaulted").checkpoint(eager=True)
    fitted = model.leaf_table(spark).withColumnsRenamed({c: f"fit_{c}" for c in ("n", "gradient", "hessian")})
    both = fitted.join(again, ["tree", "leaf"], "full")
    same = F.coalesce((F.col("fit_n") == F.col("n")) & (F.col("fit_gradient") == F.col("gradient")) & (F.col("fit_hessian") == F.col("hessian")), F.lit(False))
    point = F.lit(float(boosting.POINT))
    left = F.col("value") * (F.col("hessian") / point + F.lit(params.reg_lambda)) + F.lit(params.learning_rate) * F.col("gradient") / point
    return both.groupBy("tree").agg(
        F.sum("n").alias("n_rows"), F.count_if(~same).alias("n_differences"),
        F.count_if(F.abs(left) > 1e-9 * (1 + F.abs(F.col("gradient")) / point)).alias("n_unsolved"),
        ((F.count("*") <= params.leaves) & (F.min("n") >= F.when(F.count("*") > 1, params.min_rows).otherwise(0))).alias("in_limits"))


@query("ml8_model_table")
def q_model_table(spark, sf):
    """ML-4/5/6/8 + EV-10 + SRT-4: train the three candidates on the training window; per model
    AUC train/valid, KS (20 buckets) and PSI of the score on valid; the best by valid AUC.

    Scoring happens once per model (checkpointed (model, split, label, p) rows); AUC for all
    models and both windows is one grouped ranking pass, PSI for all models one stacked pass.
    The candidates are fitted at the same time: boosting is over a thousand short jobs in sequence, whose gaps the others fill.
    Both ensembles grow on one set of binned rows.
    """
    bs = bureau_rows(spark, sf)
    # used by three fits and three scorings: keep it cached (recomputed from the written rows if an
    # executor and its blocks are lost)
    d = bureau_design(bs, spread_by_rows(bs, "customer_id", bs.count())).persist(StorageLevel.MEMORY_AND_DISK)
    train = d.where(F.col("split") == "train")
    binned = forests.bin_rows(train.withColumn("features", vector_to_array("features")), "defaulted", "customer_id")  # for both ensembles
    scored = None
    estimators = bureau_estimators(train.count())

    def fitted(estimator):
        return forests.fit_trees(binned, estimator) if isinstance(estimator, forests.TreeParams) else estimator.fit(train)

    with ThreadPoolExecutor(len(estimators)) as pool:
        fits = {name: pool.submit(inheritable_thread_target(spark)(fitted), est) for name, est in estimators.items()}
        models = {name: fit.result() for name, fit in fits.items()}
    binned.release()
    for name, model in models.items():
        one = candidate_scores(model, d).select(F.lit(name).alias("model"), "split", "defaulted", "p")
        scored = one if scored is None else scored.unionByName(one)
    scored = scored.checkpoint(eager=True)  # every model applied once; the metrics read this
    d.unpersist()
    def aucs():
        return metrics.auc_exact_by(scored, ["model", "split"], "p", "defaulted").select(
            "model", F.concat(F.lit("auc_"), F.col("split")).alias("metric"), F.col("auc").alias("value"))

    def psis():
        stacked = scored.select(F.when(F.col("split") == "train", "expected").otherwise("actual").alias("period"),
                                F.col("model").alias("feature"), F.col("p").alias("value"))
        return drift.psi_by_feature(stacked).select(F.col("feature").alias("model"), F.lit("psi_valid_vs_train").alias("metric"),
                                                    F.col("psi").alias("value"))

    def ks(name):
        valid = scored.where((F.col("model") == name) & (F.col("split") == "valid"))
        return metrics.ks_qcut(valid, "p", "defaulted", 20).select(
            F.lit(name).alias("model"), F.lit("ks_valid").alias("metric"), F.col("ks_qcut").alias("value"))

    # each metric sorts the scores in some short jobs in sequence
    with ThreadPoolExecutor(2 + len(models)) as pool:
        parts = [pool.submit(inheritable_thread_target(spark)(f), *args) for f, *args in ((aucs,), (psis,), *((ks, name) for name in models))]
        long = reduce(DataFrame.unionByName, [part.result() for part in parts])
    names = ["auc_train", "auc_valid", "ks_valid", "psi_valid_vs_train"]
    rows = long.groupBy("model").agg(*[F.max(F.when(F.col("metric") == n, F.col("value"))).alias(n) for n in names])
    best = governance.best_by(rows, "model", "auc_valid").select(F.col("best_model").alias("_best"))
    # one best row: the comparison is done per model row against it (one-row side)
    return rows.join(F.broadcast(best), F.col("model") == F.col("_best"), "left").select(
        *rows.columns, F.col("_best").isNotNull().alias("is_best"))
