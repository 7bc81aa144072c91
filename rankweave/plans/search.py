"""Search of parameters by successive halving: many short fits at once over one staged feature matrix, longer ones for those that lead."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import ml
from ..roles import ROLES, Roles
from ..sources import tables

COLUMNS = "rung int, budget int, trial int, params string, value double, kept boolean, best boolean"


def rungs(trials: int, full: int, least: int, factor: int) -> list[tuple[int, int]]:
    """``(number of trials, budget)`` of each rung: budgets grow by ``factor`` up to the full one, and the trials shrink by it."""
    budgets = [full]
    while budgets[0] // factor >= least:
        budgets.insert(0, budgets[0] // factor)
    out = []
    for b in budgets:
        out.append((trials, b))
        trials = max(1, -(-trials // factor))
    return out


def staged_matrix(df: DataFrame, features: Iterable[str], name: str, kind: str, roles: Roles = ROLES) -> DataFrame:
    """Identity, label as a double and the feature vector, as a table: the frame is read once, whatever number of fits follows."""
    features = list(features)
    matrix = ml.feature_matrix(df, features, missing=ml.MISSING[kind]).select(*roles.identity, F.col(roles.label).cast("double").alias(roles.label), "features")
    return tables.staged(matrix, name)


def halving_search(train: DataFrame, val: DataFrame, features: Iterable[str], trials: list[dict[str, object]], kind: str = "logistic", resource: str = "maxIter", full: int = 16,
                   least: int = 2, factor: int = 2, at_once: int = 4, evaluator: ml.RankingEvaluator | None = None, roles: Roles = ROLES) -> DataFrame:
    """``rung, budget, trial, params, value, kept, best`` of every fit.

    All trials are fitted with the least budget of ``resource``, and the better part of each rung
    goes on to the next, up to the full budget; of equal values the earlier trial is kept. Up to
    ``at_once`` fits run at a time, each in a scheduler pool of its own, so that under
    ``spark.scheduler.mode=FAIR`` they share the executors. Both matrices are staged once. Only
    parameters and values reach the driver.
    """
    spark, features, evaluator = train.sparkSession, list(features), evaluator or ml.RankingEvaluator()
    matrix, held = staged_matrix(train, features, "train-matrix", kind, roles), staged_matrix(val, features, "held-matrix", kind, roles)

    def fit(job: tuple[int, int]) -> float:
        trial, budget = job
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"trial-{trial}")
        model = ml.portable(ml.ESTIMATORS[kind](featuresCol="features", labelCol=roles.label, **{**trials[trial], resource: budget}).fit(matrix))
        scored = model.transform(held).select(*roles.identity, F.col(roles.label).cast("int").alias(roles.label), vector_to_array("probability")[1].alias(roles.score))
        return evaluator.evaluate(scored)

    rows, left = [], list(range(len(trials)))
    plan = rungs(len(trials), full, least, factor)
    with ThreadPoolExecutor(at_once) as pool:
        for rung, (n, budget) in enumerate(plan):
            left = left[:n]
            values = dict(zip(left, pool.map(inheritable_thread_target(spark)(fit), [(t, budget) for t in left]), strict=True))
            left = sorted(left, key=lambda t: (-values[t], t))
            kept = set(left[: plan[rung + 1][0] if rung + 1 < len(plan) else 1])
            rows += [(rung, budget, t, str(sorted(trials[t].items())), values[t], t in kept, rung + 1 == len(plan) and t in kept) for t in sorted(values)]
    return spark.createDataFrame(rows, COLUMNS)


def refit_best(train: DataFrame, dev: DataFrame, features: Iterable[str], found: DataFrame, trials: list[dict[str, object]], kind: str = "logistic", resource: str = "maxIter", roles: Roles = ROLES):
    """A model of the best trial's parameters and budget, on both parts."""
    best = found.where("best").first()
    return ml.refit(train, dev, features, kind, roles, **{**trials[best.trial], resource: best.budget})
