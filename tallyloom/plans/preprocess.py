"""Fitted preprocessing as MLlib stages: clean, engineer, impute and scale, one-hot, assemble."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, Transformer
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom import spec as specs
from tallyloom.operators.cleaning import clean, engineer, fill_categories
from tallyloom.operators.ordering import fitted_quantiles
from tallyloom.spec import TabularSpec

MAX_CATEGORIES = 10_000


def require_low_cardinality(df: DataFrame, columns, limit: int = MAX_CATEGORIES) -> DataFrame:
    """One-hot labels of every column reach the driver, so their number is checked first."""
    counts = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns]).first().asDict()
    wide = sorted(c for c, n in counts.items() if n > limit)
    if wide:
        raise ValueError(f"too many categories to one-hot encode: {wide}")
    return df


def spec_by_name(name: str) -> TabularSpec:
    return {"TELCO": specs.TELCO, "ACCOUNT": specs.ACCOUNT}[name]


class _HasSpec(Params):
    spec = Param(Params._dummy(), "spec", "name of the column preset", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(spec="ACCOUNT")

    def _spec(self) -> TabularSpec:
        return spec_by_name(self.getOrDefault(self.spec))


class CleaningStage(Transformer, _HasSpec, DefaultParamsReadable, DefaultParamsWritable):
    """Stateless cleaning; expressions only."""

    @keyword_only
    def __init__(self, *, spec: str = "ACCOUNT"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return clean(dataset, self._spec())


class FeatureStage(Transformer, _HasSpec, DefaultParamsReadable, DefaultParamsWritable):
    """Stateless derived features, then missing categories filled."""

    @keyword_only
    def __init__(self, *, spec: str = "ACCOUNT"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        s = self._spec()
        return fill_categories(engineer(dataset, s), s.model_categorical)

    def feature_names_out(self) -> list[str]:
        s = self._spec()
        return [*s.features, *specs.DERIVED_CATEGORICAL, *specs.DERIVED_NUMERIC]


class _Columns(Params):
    inputCols = Param(Params._dummy(), "inputCols", "numeric columns", TypeConverters.toListString)
    suffix = Param(Params._dummy(), "suffix", "suffix of outputs", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(suffix="_scaled")


class MedianScaler(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Exact median for missing values, then (x - mean) / population deviation.

    A constant column keeps scale 1. Two passes: ordered quantiles, then moments.
    """

    @keyword_only
    def __init__(self, *, inputCols=None, suffix: str = "_scaled"):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> MedianScalerModel:
        cols = self.getOrDefault(self.inputCols)
        numbers = dataset.select(*[F.col(c).cast("double").alias(c) for c in cols])
        median = {c: v[0] if v else 0.0 for c, v in fitted_quantiles(numbers, cols, [0.5]).items()}
        filled = {c: F.coalesce(F.nanvl(F.col(c), F.lit(None)), F.lit(median[c])) for c in cols}
        moments = numbers.agg(
            *[F.avg(filled[c]).alias(f"m{i}") for i, c in enumerate(cols)],
            *[F.stddev_pop(filled[c]).alias(f"s{i}") for i, c in enumerate(cols)],
        ).first()
        mean = [float(moments[f"m{i}"] or 0.0) for i in range(len(cols))]
        scale = [float(moments[f"s{i}"] or 0.0) or 1.0 for i in range(len(cols))]
        return MedianScalerModel(
            inputCols=cols,
            suffix=self.getOrDefault(self.suffix),
            medians=[median[c] for c in cols],
            means=mean,
            scales=scale,
        )


class MedianScalerModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    medians = Param(Params._dummy(), "medians", "per column", TypeConverters.toListFloat)
    means = Param(Params._dummy(), "means", "per column", TypeConverters.toListFloat)
    scales = Param(Params._dummy(), "scales", "per column", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, suffix=None, medians=None, means=None, scales=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        get = self.getOrDefault
        suffix = get(self.suffix)
        return dataset.withColumns(
            {
                f"{c}{suffix}": (
                    F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None)), F.lit(median)) - mean
                )
                / scale
                for c, median, mean, scale in zip(
                    get(self.inputCols), get(self.medians), get(self.means), get(self.scales)
                )
            }
        )


def one_hot_stages(columns) -> list:
    """Alphabetical slots, all of them kept; an unseen category gives the zero vector."""
    indexed = [f"{c}_index" for c in columns]
    return [
        StringIndexer(
            inputCols=list(columns),
            outputCols=indexed,
            handleInvalid="keep",
            stringOrderType="alphabetAsc",
        ),
        OneHotEncoder(
            inputCols=indexed, outputCols=[f"{c}_slots" for c in columns], dropLast=True
        ),
    ]


def encoder_stages(s: TabularSpec) -> list:
    """The fitted part: everything that learns from the training rows."""
    return [
        MedianScaler(inputCols=list(s.model_numeric)),
        *one_hot_stages(s.model_categorical),
        VectorAssembler(
            inputCols=[
                *[f"{c}_scaled" for c in s.model_numeric],
                *[f"{c}_slots" for c in s.model_categorical],
            ],
            outputCol="features",
        ),
    ]


def stateless_stages(spec_name: str) -> list:
    return [CleaningStage(spec=spec_name), FeatureStage(spec=spec_name)]


def full_pipeline(spec_name: str, estimator=None) -> Pipeline:
    """One object for training and serving."""
    stages = [*stateless_stages(spec_name), *encoder_stages(spec_by_name(spec_name))]
    return Pipeline(stages=stages + ([estimator] if estimator is not None else []))


def slot_names(fitted, s: TabularSpec) -> list[tuple[str, str | None]]:
    """(source column, category or None) of every position of the feature vector."""
    indexer = next(st for st in fitted.stages if type(st).__name__ == "StringIndexerModel")
    names: list[tuple[str, str | None]] = [(c, None) for c in s.model_numeric]
    for column, labels in zip(s.model_categorical, indexer.labelsArray):
        names += [(column, label) for label in labels]
    return names
