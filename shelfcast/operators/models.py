"""Volume and share models on MLlib."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, GeneralizedLinearRegression
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.operators.recursion import Predictor

# Fixed value: variance power of the Tweedie objective.
TWEEDIE_POWER = 1.5


@contextmanager
def kept(df: DataFrame):
    """Keep training rows while a fit passes over them many times; a lost block is recomputed."""
    stored = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield stored
    finally:
        stored.unpersist()


def feature_stages(numeric: Sequence[str], categorical: Sequence[str]) -> list:
    """Scaled numeric features and indicator columns of small categories, in one vector.

    Attributes with very many values belong in a target-mean column instead: a
    generalised linear model solves for at most 4,096 features.
    """
    stages = [VectorAssembler(inputCols=list(numeric), outputCol="_numeric", handleInvalid="keep"),
              StandardScaler(inputCol="_numeric", outputCol="_scaled", withMean=True)]
    if categorical:
        index = [f"_{c}_index" for c in categorical]
        flags = [f"_{c}_flags" for c in categorical]
        stages += [
            StringIndexer(inputCols=list(categorical), outputCols=index, handleInvalid="keep", stringOrderType="alphabetAsc"),
            OneHotEncoder(inputCols=index, outputCols=flags, handleInvalid="keep"),
            VectorAssembler(inputCols=["_scaled", *flags], outputCol="features"),
        ]
    else:
        stages.append(VectorAssembler(inputCols=["_scaled"], outputCol="features"))
    return stages


def _glm(label: str, weight: str | None, **kind) -> GeneralizedLinearRegression:
    model = GeneralizedLinearRegression(labelCol=label, featuresCol="features", maxIter=25, regParam=1e-3, **kind)
    return model.setWeightCol(weight) if weight else model


def poisson_model(label: str = "sales", weight: str | None = None) -> GeneralizedLinearRegression:
    return _glm(label, weight, family="poisson", link="log")


def tweedie_model(label: str = "sales", weight: str | None = None) -> GeneralizedLinearRegression:
    return _glm(label, weight, family="tweedie", variancePower=TWEEDIE_POWER, linkPower=0.0)


def share_model(label: str = "share", weight: str | None = None) -> GeneralizedLinearRegression:
    """Cross-entropy on fractional labels."""
    return _glm(label, weight, family="binomial", link="logit")


def unpenalised(model: GeneralizedLinearRegression) -> GeneralizedLinearRegression:
    """The same model with a penalty that only settles collinear indicators, iterated further."""
    return model.setRegParam(1e-9).setMaxIter(100).setTol(1e-9)


def tree_model(label: str = "sales", weight: str | None = None, rounds: int = 20, depth: int = 5, seed: int = 1) -> GBTRegressor:
    model = GBTRegressor(labelCol=label, featuresCol="features", maxIter=rounds, maxDepth=depth, seed=seed, subsamplingRate=0.75)
    return model.setWeightCol(weight) if weight else model


def train(
    rows: DataFrame, estimator, numeric: Sequence[str], categorical: Sequence[str] = (), label: str = "sales",
    unknown: float | None = None,
) -> PipelineModel:
    """Fit on the rows whose features and label are all known.

    With ``unknown``, missing numeric features take that value instead of
    losing the row; a share that is undefined on one day would otherwise blank
    a month of rolling means.

    Models with a log link are fitted to a label scaled to mean 0.1 and their
    predictions scaled back, which leaves the fit the same up to its intercept.
    The solver starts from ``max(label, 0.1)``; on mostly-zero sales that start
    is far off, and it would diverge or take dozens of passes to return.
    """
    weight = estimator.getOrDefault("weightCol") if estimator.isSet("weightCol") else None
    used = list(dict.fromkeys([*numeric, *categorical, label, *([weight] if weight else [])]))
    complete = rows.select(*used)
    if unknown is not None:
        complete = complete.na.fill(unknown, subset=list(numeric))
    rows = complete.na.drop("any")
    prepared = Pipeline(stages=feature_stages(numeric, categorical)).fit(rows)
    # the solver passes over the finished vectors, not over the stages that build them
    with kept(prepared.transform(rows).select("features", label, *([weight] if weight else []))) as stored:
        if not (isinstance(estimator, GeneralizedLinearRegression) and estimator.getOrDefault("family") in ("poisson", "tweedie")):
            return PipelineModel([*prepared.stages, estimator.fit(stored)])
        unit = 10.0 * stored.agg(F.avg(label)).first()[0]
        scaled = estimator.copy().setLabelCol("_label").setPredictionCol("_scaled_prediction")
        model = scaled.fit(stored.withColumn("_label", F.col(label) / unit))
        back = SQLTransformer(statement=f"SELECT *, _scaled_prediction * {unit!r}D AS prediction FROM __THIS__")
        return PipelineModel([*prepared.stages, model, back])


def predictor(*models: PipelineModel, numeric: Sequence[str] = ()) -> Predictor:
    """The mean prediction of several fitted models; unknown numeric features count as 0."""

    def predict(rows: DataFrame) -> DataFrame:
        plain = rows.columns
        filled = rows.na.fill(0.0, subset=list(numeric))
        for i, model in enumerate(models):
            scored = model.transform(filled)
            filled = scored.select(*plain, *[c for c in (f"_p{j}" for j in range(i)) if c in scored.columns],
                                   F.col("prediction").alias(f"_p{i}"))
        total = sum((F.col(f"_p{i}") for i in range(1, len(models))), F.col("_p0"))
        return filled.select(*plain, (total / len(models)).alias("prediction"))

    return predict


def softmax_share_model(
    rows: DataFrame, item: str, weight: str, categorical: Sequence[str], penalty: float = 1e-3
) -> tuple[PipelineModel, list[str]]:
    """Multinomial model of which item sells, given the day's attributes.

    Rows are summed per item and attribute combination first, so training cost
    does not grow with the history.  One class per item: for product lines, not
    for millions of items (those take the binomial share model).
    """
    counts = rows.groupBy(item, *categorical).agg(F.sum(weight).alias("_w")).filter(F.col("_w") > 0)
    index = StringIndexer(inputCol=item, outputCol="_label", stringOrderType="alphabetAsc")
    flags = [f"_{c}_flags" for c in categorical]
    codes = [f"_{c}_index" for c in categorical]
    stages = [
        index,
        StringIndexer(inputCols=list(categorical), outputCols=codes, stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCols=codes, outputCols=flags),
        VectorAssembler(inputCols=flags, outputCol="features"),
        LogisticRegression(labelCol="_label", weightCol="_w", family="multinomial", regParam=penalty, maxIter=30),
    ]
    with kept(counts) as stored:
        model = Pipeline(stages=stages).fit(stored)
    return model, model.stages[0].labelsArray[0]


def tune(
    rows: DataFrame, estimator, grid: Mapping[str, Sequence], numeric: Sequence[str], categorical: Sequence[str] = (),
    label: str = "sales", *, held: Column,
):
    """Fit every setting of a grid on the rows not ``held``, and measure it on those; returns the best model and ``(params, rmse)`` of each.

    Holding out whole days keeps neighbouring days, whose lags overlap, on one side.
    """
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    combos = builder.build()
    complete = rows.select(*dict.fromkeys([*numeric, *categorical, label]), held.alias("_held")).na.drop("any")
    with kept(complete) as stored:
        prepared = Pipeline(stages=feature_stages(numeric, categorical)).fit(stored.filter(~F.col("_held")))
        features = prepared.transform(stored).select("features", label, "_held")
        fitted = [model for _, model in sorted(estimator.fitMultiple(features.filter(~F.col("_held")), combos), key=lambda m: m[0])]
        measure = RegressionEvaluator(labelCol=label)
        errors = [measure.evaluate(model.transform(features.filter("_held"))) for model in fitted]
    described = [", ".join(f"{p.name}={v}" for p, v in sorted(c.items(), key=lambda x: x[0].name)) for c in combos]
    return fitted[errors.index(min(errors))], list(zip(described, errors))


def tune_rounds(
    rows: DataFrame, depths: Sequence[int], rounds: int, numeric: Sequence[str], categorical: Sequence[str] = (),
    label: str = "sales", *, held: Column, seed: int = 1,
) -> list[tuple[int, int, float]]:
    """``(depth, rounds, rmse)`` on the ``held`` rows, for every number of rounds up to ``rounds``: one fit per depth.

    A boosted model of ``n`` rounds is the beginning of a longer one, so the errors
    of all shorter models are read off the longest in one pass over the held rows.
    """
    complete = rows.select(*dict.fromkeys([*numeric, *categorical, label]), held.alias("_held")).na.drop("any")
    found = []
    with kept(complete) as stored:
        prepared = Pipeline(stages=feature_stages(numeric, categorical)).fit(stored.filter(~F.col("_held")))
        with kept(prepared.transform(stored).select("features", label, "_held")) as features:
            past, ahead = features.filter(~F.col("_held")), features.filter("_held")
            for depth in depths:
                model = tree_model(label, rounds=rounds, depth=depth, seed=seed).fit(past)
                errors = model.evaluateEachIteration(ahead, "squared")
                found += [(depth, k + 1, float(e) ** 0.5) for k, e in enumerate(errors)]
    return found


def importances(model: PipelineModel, rows: DataFrame) -> list[tuple[str, float]]:
    """Feature names with the importance (trees) or coefficient (linear) the model gives them."""
    last = next(s for s in reversed(model.stages) if hasattr(s, "featureImportances") or hasattr(s, "coefficients"))
    values = last.featureImportances if hasattr(last, "featureImportances") else last.coefficients
    attributes = model.transform(rows.limit(1)).schema["features"].metadata["ml_attr"]["attrs"]
    numeric = model.stages[0].getInputCols()
    names = {a["idx"]: a["name"].lstrip("_").replace("_flags_", "=") for group in attributes.values() for a in group}
    names.update(enumerate(numeric))
    return [(names.get(i, f"feature_{i}"), float(v)) for i, v in enumerate(values.toArray())]
