"""Saved stages: what a loaded pipeline computes equals the fitted one, unseen and null levels included."""

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array

from riskloom.operators import stages
from riskloom.plans import saved_pipelines

from conftest import SF_SMALL


def test_pipeline_is_saved_and_loaded(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", "x", 10.0), (2, "b", None, -3.0), (3, None, "y", 0.0), (4, "c", "x", 7.5)], "k int, u string, v string, w double")
    steps = [stages.LogFeatures(inputCols=["w"]), stages.LogBins(inputCols=["w_log"], cuts=[0.5, 2.2]), stages.LevelIndexer(inputCols=["u", "v"]),
             stages.PopulationScaler(inputCols=["w"]), VectorAssembler(inputCols=["w_z", "u_vec", "w_log_bin", "v_vec"], outputCol="f")]
    model = Pipeline(stages=steps).fit(df.where("k < 4"))
    model.write().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m"))

    def rows(m):
        return [tuple(r.f) for r in m.transform(df).orderBy("k").select(vector_to_array("f").alias("f")).collect()]

    got = rows(model)
    assert got == rows(loaded)
    assert [r[1:] for r in got] == [(1, 0, 2, 1, 0), (0, 1, 0, 0, 0), (0, 0, 0, 0, 1), (0, 0, 1, 1, 0)]  # an unseen or null level is all zeros
    names = [(r.position, r.name, r.kind) for r in stages.manifest(loaded).orderBy("position").collect()]
    assert names == [(0, "w_z", "numeric"), (1, "u_a", "onehot"), (2, "u_b", "onehot"), (3, "w_log_bin", "numeric"), (4, "v_x", "onehot"), (5, "v_y", "onehot")]


def test_fits_and_scorings_read_the_loans_without_their_joins(spark):
    df = saved_pipelines.loans_for_model(spark, SF_SMALL)
    assert df.inputFiles() and all("/loans-" in f for f in df.inputFiles())
    assert set(saved_pipelines.LOG_COLUMNS + saved_pipelines.ONEHOT_COLUMNS) < set(df.columns)
