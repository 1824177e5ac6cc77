"""FE-9/FE-11: the library's encoder, scaler and log features as spark.ml stages that can be saved, loaded and scored.

A fitted pipeline with them is one ``PipelineModel``: ``write().save(path)`` on any Hadoop file system, ``PipelineModel.load``
elsewhere. Levels are kept as a table beside the stage's metadata, so a column may have any number of them; a
column's one-hot form is a sparse vector, and ``manifest`` names its places without a schema column per level.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, PipelineModel, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.columns import safe_log1p
from riskloom.operators.features import CategoryEncoder, Standardizer


class LogFeatures(Transformer, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """PRJ-15: ``<col>_log`` = log1p of the non-negative part of each input column; null stays null."""

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({f"{c}_log": safe_log1p(c) for c in self.getInputCols()})


class _Bins(Params):
    cuts = Param(Params._dummy(), "cuts", "ascending cuts; a bin is the number of cuts at or below the value", TypeConverters.toListFloat)


class LogBins(Transformer, HasInputCols, _Bins, DefaultParamsReadable, DefaultParamsWritable):
    """PRJ-15: ``<col>_bin`` = number of ``cuts`` at or below each (log) column, as a double; null stays null."""

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] | None = None, cuts: Sequence[float] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        cuts = self.getOrDefault(self.cuts)
        return df.withColumns({f"{c}_bin": sum((F.when(F.col(c) >= F.lit(x), 1.0).otherwise(0.0) for x in cuts), F.when(F.col(c).isNotNull(), 0.0)) for c in self.getInputCols()})


class LevelIndexer(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """FE-6: fits the levels of string columns; the model adds a sparse ``<col>_vec`` each (an unseen or null level is all zeros)."""

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "LevelIndexerModel":
        encoder = CategoryEncoder(self.getInputCols()).fit(df)
        model = LevelIndexerModel(encoder.table, [encoder.sizes[c] for c in self.getInputCols()])
        return model._set(inputCols=self.getInputCols())


class LevelIndexerModel(Model, HasInputCols, MLReadable, MLWritable):
    """``table``: (feature, level, index); ``sizes``: levels of each input column."""

    def __init__(self, table: DataFrame, sizes: Sequence[int]):
        super().__init__()
        self.table, self.sizes = table, list(sizes)

    def encoder(self) -> CategoryEncoder:
        out = CategoryEncoder(self.getInputCols())
        out.table, out.sizes = self.table, dict(zip(self.getInputCols(), self.sizes))
        return out

    def _transform(self, df: DataFrame) -> DataFrame:
        return self.encoder().transform_vector(df).drop(*[f"{c}_idx" for c in self.getInputCols()])

    def write(self) -> MLWriter:
        return _LevelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _LevelReader()


class _LevelWriter(MLWriter):
    def __init__(self, model: LevelIndexerModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, extraMetadata={"sizes": self.model.sizes})
        self.model.table.write.parquet(f"{path}/levels")


class _LevelReader(MLReader):
    def load(self, path: str) -> LevelIndexerModel:
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = LevelIndexerModel(self.sparkSession.read.parquet(f"{path}/levels"), meta["sizes"])
        model._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(model, meta)
        return model


class PopulationScaler(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """FE-7: fits mean and population sd of the input columns; the model adds ``<col>_z``."""

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "PopulationScalerModel":
        s = Standardizer(self.getInputCols()).fit(df)
        names = self.getInputCols()
        return PopulationScalerModel()._set(inputCols=names, means=[s.mean[c] or 0.0 for c in names], deviations=[s.sd[c] for c in names])


class PopulationScalerModel(Model, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    means = Param(Params._dummy(), "means", "mean of each column", TypeConverters.toListFloat)
    deviations = Param(Params._dummy(), "deviations", "population sd of each column", TypeConverters.toListFloat)

    def _transform(self, df: DataFrame) -> DataFrame:
        s = Standardizer(self.getInputCols())
        s.mean, s.sd = (dict(zip(self.getInputCols(), self.getOrDefault(p))) for p in (self.means, self.deviations))
        return s.transform(df)


def manifest(model: PipelineModel) -> DataFrame:
    """FE-9: (position, name, source, kind) of the places of the assembled vector, from the stages of a fitted or loaded pipeline.

    Level names come from the levels table; the driver sees one number per input column of the assembler.
    """
    levels = next(s for s in model.stages if isinstance(s, LevelIndexerModel))
    sizes = dict(zip((f"{c}_vec" for c in levels.getInputCols()), levels.sizes))
    assembler = next(s for s in model.stages if isinstance(s, VectorAssembler))
    starts, at, plain = {}, 0, []
    for c in assembler.getInputCols():
        if c in sizes:
            starts[c.removesuffix("_vec")] = at
        else:
            plain.append((at, c, c, "numeric"))
        at += sizes.get(c, 1)
    before = F.coalesce(*[F.when(F.col("feature") == c, F.lit(n)) for c, n in starts.items()])
    named = levels.table.select((F.col("index") + before).cast("int").alias("position"), F.concat_ws("_", "feature", "level").alias("name"),
                                F.col("feature").alias("source"), F.lit("onehot").alias("kind")).where("position is not null")
    return named.unionByName(levels.table.sparkSession.createDataFrame(plain, "position int, name string, source string, kind string"))
