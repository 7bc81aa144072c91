"""Pointwise models on Spark ML: fitting, ranking evaluators, search, calibration and importance."""

from __future__ import annotations

import random
from collections.abc import Iterable

from pyspark import SparkContext
from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..roles import ROLES, Roles
from .metrics import enrich, macro_average, overall_metrics, per_item_ap, per_query_metrics

#: Estimators by name; more can be registered.
ESTIMATORS = {"logistic": LogisticRegression, "gbt": GBTClassifier}
#: What a null counts as: nothing for linear models, less than any value for trees, which can split it off.
MISSING = {"logistic": 0.0, "gbt": -1e30}


def feature_matrix(df: DataFrame, features: Iterable[str], out: str = "features", missing: float = float("nan")) -> DataFrame:
    """Numeric and encoded features as a vector of doubles, with ``missing`` for nulls and NaN."""
    features = list(features)
    filled = df.withColumns({f"__f {f}": F.coalesce(F.nanvl(F.col(f).cast("double"), F.lit(None)), F.lit(missing)) for f in features})
    made = VectorAssembler(inputCols=[f"__f {f}" for f in features], outputCol=out, handleInvalid="keep").transform(filled)
    return made.drop(*(f"__f {f}" for f in features))


def portable(model: Model) -> Model:
    """A fitted model without its training summary: that holds the training frame, and with it the session, which can't travel to tasks once queries are observed in it."""
    own = getattr(model, "_java_obj", None)
    if own is not None and getattr(model, "hasSummary", False):
        own.setSummary(SparkContext._active_spark_context._jvm.scala.Option.apply(None))
    return model


def fit_pointwise(train: DataFrame, features: Iterable[str], kind: str = "logistic", weight: str | None = None, dev: DataFrame | None = None,
                  roles: Roles = ROLES, **params: object) -> Model:
    """A model of the label; ``dev`` rows stop boosting early. Nulls count as MISSING says."""
    features = list(features)
    own = train.withColumn("__dev", F.lit(False))
    if dev is not None:
        own = own.unionByName(dev.withColumn("__dev", F.lit(True)))
    own = feature_matrix(own, features, missing=MISSING[kind]).withColumn(roles.label, F.col(roles.label).cast("double"))
    estimator = ESTIMATORS[kind](featuresCol="features", labelCol=roles.label, **params)
    if weight:
        estimator.setWeightCol(weight)
    if dev is not None and kind == "gbt":
        estimator.setValidationIndicatorCol("__dev")
    elif dev is not None:
        own = own.where("not __dev")
    return portable(estimator.fit(own))


def refit(train: DataFrame, dev: DataFrame, features: Iterable[str], kind: str, roles: Roles = ROLES, **params: object) -> Model:
    """On both parts, with a fixed number of iterations."""
    return fit_pointwise(train.unionByName(dev), features, kind, roles=roles, **params)


def score(df: DataFrame, model: Model, features: Iterable[str], out: str = "score") -> DataFrame:
    features = list(features)
    own = feature_matrix(df, features, missing=MISSING["logistic" if "Logistic" in type(model).__name__ else "gbt"])
    return model.transform(own).withColumn(out, vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")


class RankingEvaluator(Evaluator):
    """Mean AP over queries, or macro AP over items, of a scored frame."""

    def __init__(self, metric: str = "map", k: int = 10, roles: Roles = ROLES):
        super().__init__()
        self.metric, self.k, self.roles = metric, k, roles

    def _evaluate(self, dataset: DataFrame) -> float:
        own = enrich(dataset, [self.k], self.roles)
        if self.metric == "map":
            value = overall_metrics(per_query_metrics(own, [self.k], self.roles), [self.k]).first()[f"map@{self.k}"]
        else:
            value = macro_average(per_item_ap(own, self.k, None, self.roles), ["ap"]).first()["macro_ap"]
        return float(value or 0.0)

    def isLargerBetter(self) -> bool:
        return True


def search_space(space: dict[str, tuple], trials: int, seed: int = 0) -> list[dict[str, object]]:
    """Random parameters: ("int", lo, hi), ("float", lo, hi), ("log", lo, hi) or ("choice", values)."""
    rng = random.Random(seed)

    def draw(kind: str, *args):
        if kind == "int":
            return rng.randint(*args)
        if kind == "float":
            return rng.uniform(*args)
        if kind == "log":
            lo, hi = args
            return lo * (hi / lo) ** rng.random()
        return rng.choice(list(args[0]))

    return [{name: draw(*spec) for name, spec in space.items()} for _ in range(trials)]


def search_best(train: DataFrame, val: DataFrame, features: Iterable[str], trials: list[dict[str, object]], kind: str = "logistic",
                evaluator: RankingEvaluator | None = None, roles: Roles = ROLES) -> DataFrame:
    """``trial, params, value, best`` of each set of parameters on ``val``."""
    evaluator, rows = evaluator or RankingEvaluator(), []
    features = list(features)
    for i, params in enumerate(trials):
        model = fit_pointwise(train, features, kind, roles=roles, **params)
        rows.append((i, str(sorted(params.items())), evaluator.evaluate(score(val.drop(roles.score), model, features, roles.score))))
    top = max(r[2] for r in rows)
    return train.sparkSession.createDataFrame([(*r, r[2] == top) for r in rows], "trial int, params string, value double, best boolean")


def calibrate(held: DataFrame, df: DataFrame, method: str = "isotonic", roles: Roles = ROLES) -> DataFrame:
    """``df`` with its score calibrated on ``held`` and the raw one as ``score_uncalibrated``."""
    raw = roles.score
    fit = held.select(F.col(raw).alias("__s"), F.col(roles.label).cast("double").alias("__y"))
    out = df.withColumn("score_uncalibrated", F.col(raw)).withColumn("__s", F.col(raw))
    if method == "isotonic":
        done = IsotonicRegression(featuresCol="__s", labelCol="__y").fit(fit).transform(out)
        return done.withColumn(raw, F.least(F.greatest("prediction", F.lit(0.0)), F.lit(1.0))).drop("__s", "prediction")
    model = portable(LogisticRegression(featuresCol="__v", labelCol="__y").fit(VectorAssembler(inputCols=["__s"], outputCol="__v").transform(fit)))
    done = model.transform(VectorAssembler(inputCols=["__s"], outputCol="__v").transform(out))
    return done.withColumn(raw, vector_to_array("probability")[1]).drop("__s", "__v", "rawPrediction", "probability", "prediction")


def feature_importance(spark, model: Model, features: Iterable[str]) -> DataFrame:
    """``feature, importance, dead``: a boosted model's importances, or the size of a linear model's coefficients."""
    values = model.featureImportances.toArray() if hasattr(model, "featureImportances") else abs(model.coefficients.toArray())
    rows = [(f, float(v), bool(v == 0)) for f, v in zip(features, values, strict=True)]
    return spark.createDataFrame(rows, "feature string, importance double, dead boolean")
