"""Registered queries of the saved pipeline and of the loan design with sparse one-hot columns (FE-9, FE-11, PRJ-15, PRJ-16)."""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskloom.operators import splits, stages
from riskloom.plans import catalog
from riskloom.plans.catalog import CLEAN_LOANS_SQL, D, query
from riskloom.session import ensure_checkpoint_dir

LABEL, KEY = "loan_status_flag", "loan_id"
# Fixed values that must equal the reference's: columns whose log, bin and one-hot forms the weighted model names.
LOG_COLUMNS = ["loan_amount", "monthly_income", "cltv"]
ONEHOT_COLUMNS = ["plan_type", "util_bin"]
#: Cuts of the log of cltv (the reference names the bins and does not define them).
CLTV_LOG_CUTS = [2.0, 4.0, 6.0, 8.0]

_SPLIT_SQL = f"""s AS (SELECT *, CASE WHEN ('0x' || substr(md5(CAST({KEY} AS VARCHAR)), 1, 4))::INT % 100 < 80 THEN 'train' ELSE 'test' END AS split
  FROM clean WHERE fico_score IS NOT NULL AND tenure_months IS NOT NULL)"""


def loans_for_model(spark, sf):
    """The columns that the pipelines name, of the cleaned loans with complete features and a stable split. Each stage's fit and
    each scoring reads them, so the joins are done once and the rows are kept as Parquet in the shared folder."""
    df = catalog.clean_loans(spark, sf).dropna(subset=["fico_score", "tenure_months", *LOG_COLUMNS, LABEL])
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/loans-{uuid.uuid4().hex}"
    columns = [KEY, "fico_score", "tenure_months", *LOG_COLUMNS, *ONEHOT_COLUMNS, LABEL, "split"]
    splits.with_hash_split(df, KEY, 80).select(*columns).write.parquet(folder)
    return spark.read.parquet(folder)


def design_stages() -> list:
    logs = [f"{c}_log" for c in LOG_COLUMNS]
    scaled = ["fico_score", "tenure_months"]
    inputs = [f"{c}_z" for c in scaled] + logs + ["cltv_log_bin"] + [f"{c}_vec" for c in ONEHOT_COLUMNS]
    return [
        stages.LogFeatures(inputCols=LOG_COLUMNS),
        stages.LogBins(inputCols=["cltv_log"], cuts=CLTV_LOG_CUTS),
        stages.LevelIndexer(inputCols=ONEHOT_COLUMNS),
        stages.PopulationScaler(inputCols=scaled),
        VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="error"),
    ]


def _log_sql(c: str) -> str:
    return f"ROUND(LN(1 + GREATEST({c}, {D(0)})), 9)"


_PLACES = [(f"{c}_log", _log_sql(c)) for c in LOG_COLUMNS] + [
    ("cltv_log_bin", " + ".join(f"(CASE WHEN LN(1 + GREATEST(cltv, {D(0)})) >= {D(x)} THEN {D(1)} ELSE {D(0)} END)" for x in CLTV_LOG_CUTS))]
_PLACES_SQL = ", ".join(f"{{'name': '{name}', 'value': {value}}}" for name, value in _PLACES)


@query("fe11_saved_pipeline", f"""WITH {CLEAN_LOANS_SQL}, {_SPLIT_SQL}
SELECT split, COUNT(*) AS n, CAST(0 AS BIGINT) AS n_different, (SELECT COUNT(DISTINCT plan_type) + COUNT(DISTINCT util_bin) FROM s WHERE split = 'train') + 6 AS n_places
FROM s GROUP BY split""", ("loans",))
def q_saved_pipeline(spark, sf):
    """FE-11/FE-9: a pipeline of the library's own stages and a logistic regression is fitted on the training rows, saved, loaded and scored: per split the
    rows, rows whose probability after loading differs from that before, and places in the loaded pipeline's manifest."""
    df = loans_for_model(spark, sf)
    model = Pipeline(stages=[*design_stages(), LogisticRegression(labelCol=LABEL, regParam=0.1)]).fit(df.where(F.col("split") == "train"))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/model-{uuid.uuid4().hex}"
    model.write().save(path)
    loaded = PipelineModel.load(path)

    def scored(m, name):
        return m.transform(df).select(KEY, "split", vector_to_array("probability")[1].alias(name))

    both = scored(model, "p").join(scored(loaded, "q"), [KEY, "split"], "full")
    places = stages.manifest(loaded).count()  # a number
    return both.groupBy("split").agg(F.count("*").alias("n"), F.count_if(~F.col("p").eqNullSafe(F.col("q"))).alias("n_different")).withColumn("n_places", F.lit(places).cast("long"))


@query("prj16_loan_design", f"""WITH {CLEAN_LOANS_SQL}, {_SPLIT_SQL},
p AS (SELECT {KEY}, UNNEST([{_PLACES_SQL}]) AS x FROM s)
SELECT {KEY}, x.name AS name, x.value AS value FROM p WHERE x.value <> 0
UNION ALL SELECT {KEY}, 'plan_type_' || plan_type, {D(1)} FROM s WHERE plan_type IN (SELECT plan_type FROM s WHERE split = 'train')
UNION ALL SELECT {KEY}, 'util_bin_' || util_bin, {D(1)} FROM s WHERE util_bin IN (SELECT util_bin FROM s WHERE split = 'train')""", ("loans",))
def q_loan_design(spark, sf):
    """PRJ-15/PRJ-16: the assembled vector of each loan, place by place with the names of the manifest (places of value 0 and the two scaled columns left out): three
    log features, the log bin, and sparse one-hot plan type and utilization bin fitted on the training rows."""
    df = loans_for_model(spark, sf)
    model = Pipeline(stages=design_stages()).fit(df.where(F.col("split") == "train"))
    places = stages.manifest(model).where(~F.col("name").endswith("_z")).select("position", "name")
    values = model.transform(df).select(KEY, F.posexplode(vector_to_array("features")).alias("position", "value")).where("value <> 0")
    return values.join(places, "position").select(KEY, "name", F.round("value", 9).alias("value"))
