"""Model training and tuning on Spark ML.

Fits run on the executors; the driver only submits them.  The tuning
sweep (O83) is a small driver thread pool of ``parallel`` concurrent
fits over one cached split — the same mechanism as
``CrossValidator(parallelism=...)`` — and its results land in the metric
log table, from where O21–O33 decide the best trial and the verdict.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trialfold.operators.features import LABEL, NUMERIC, round_and_score

FEATURES = ["gender"] + NUMERIC


def _prep(features: list[str]) -> list:
    imp = Imputer(inputCols=features, outputCols=[f"{c}_f" for c in features], strategy="mean")
    asm = VectorAssembler(inputCols=[f"{c}_f" for c in features], outputCol="features")
    return [imp, asm]


def _cast(df: DataFrame, features: list[str]) -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(c) for c in features],
                     F.col(LABEL).cast("double").alias("label"), *[c for c in df.columns if c not in features + ["label", LABEL]])


def with_weights(train: DataFrame, scale_pos_weight: float | None) -> DataFrame:
    """O77 applied: positive rows weighted by #neg/#pos."""
    w = F.lit(1.0) if scale_pos_weight is None else F.when(F.col("label") == 1.0, F.lit(float(scale_pos_weight))).otherwise(F.lit(1.0))
    return train.withColumn("w", w)


def train_gbt(train: DataFrame, test: DataFrame, learning_rate: float, n_estimators: int,
              scale_pos_weight: float | None = None, features: list[str] = FEATURES, seed: int = 42) -> PipelineModel:
    """Boosted trees, logistic loss, ``n_estimators`` rounds at rate
    ``learning_rate``; the test rows are the validation set that stops
    the boosting early; positives weighted by the class ratio."""
    tr = with_weights(_cast(train, features), scale_pos_weight).withColumn("is_val", F.lit(False))
    te = with_weights(_cast(test, features), scale_pos_weight).withColumn("is_val", F.lit(True))
    gbt = GBTClassifier(maxIter=int(n_estimators), stepSize=float(learning_rate), lossType="logistic", weightCol="w",
                        validationIndicatorCol="is_val", seed=seed)
    rows = tr.unionByName(te).select(*features, "label", "w", "is_val")
    if train.is_cached:  # ``tune`` keeps the split itself
        return Pipeline(stages=_prep(features) + [gbt]).fit(rows)
    # every pass of the fit (means, split points, rounds) reads the kept rows
    rows = rows.persist()
    try:
        return Pipeline(stages=_prep(features) + [gbt]).fit(rows)
    finally:
        rows.unpersist()


def train_forest(train: DataFrame, n_estimators: int, features: list[str] = FEATURES, seed: int = 42) -> PipelineModel:
    """Random forest with ``n_estimators`` trees."""
    rf = RandomForestClassifier(numTrees=int(n_estimators), seed=seed)
    return Pipeline(stages=_prep(features) + [rf]).fit(_cast(train, features))


def train_logistic(train: DataFrame, max_iter: int, features: list[str] = FEATURES) -> PipelineModel:
    """Logistic regression; the library default (L2, C = 1) is
    regParam = 1/n without standardisation."""
    tr = _cast(train, features)
    n = tr.count()
    lr = LogisticRegression(maxIter=int(max_iter), regParam=1.0 / max(n, 1), elasticNetParam=0.0, standardization=False)
    return Pipeline(stages=_prep(features) + [lr]).fit(tr)


def predict(model: PipelineModel, test: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    p = model.transform(_cast(test, features))
    return p.withColumn("probability", vector_to_array("probability")[1]).withColumnRenamed("label", LABEL)


def accuracy(model: PipelineModel, test: DataFrame, features: list[str] = FEATURES) -> float:
    """O82 on a model: probability rounded half-even, share equal."""
    r = round_and_score(predict(model, test, features)).collect()[0]  # one aggregate row
    return float(r["accuracy"])


def loss_curve(model: PipelineModel, test: DataFrame, every: int = 100, features: list[str] = FEATURES) -> list[tuple[int, float]]:
    """O85 (re-aimed): test loss after each boosting iteration, every
    ``every``-th kept (bounded by the number of iterations)."""
    gbt = model.stages[-1]
    prepared = PipelineModel(model.stages[:-1]).transform(with_weights(_cast(test, features), None))
    prepared = prepared.select("features", "label", "w").persist()  # one pass for each iteration
    try:
        losses = gbt.evaluateEachIteration(prepared)
    finally:
        prepared.unpersist()
    return [(i, float(v)) for i, v in enumerate(losses) if i % every == 0]


def tune(spark: SparkSession, train: DataFrame, test: DataFrame, assignments: list[dict], objective,
         max_trials: int = 6, max_failed: int = 3, parallel: int = 1, goal: float | None = 0.99) -> DataFrame:
    """Run ``objective(train, test, params) -> accuracy`` for the
    assignments with at most ``parallel`` concurrent fits; stop submitting
    once ``max_trials`` ran, ``max_failed`` failed or the goal is reached.
    Returns metric-log rows (trial, seq, metric, value) for O21–O33."""
    train, test = train.cache(), test.cache()
    try:
        rows = _sweep(train, test, assignments, objective, max_trials, max_failed, parallel, goal)
    finally:
        train.unpersist()
        test.unpersist()
    return spark.createDataFrame(rows, "trial string, seq long, metric string, value string")


def _sweep(train, test, assignments, objective, max_trials, max_failed, parallel, goal) -> list[tuple]:
    rows: list[tuple] = []
    failed, done, reached = 0, 0, False
    todo = list(enumerate(assignments[:max_trials]))
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        while todo and not reached and failed < max_failed:
            batch, todo = todo[:parallel], todo[parallel:]
            futs = [(i, p, pool.submit(objective, train, test, p)) for i, p in batch]
            for i, p, f in futs:
                try:
                    acc = f.result()
                    rows.append((f"trial-{i}", i, "accuracy", repr(float(acc))))
                    done += 1
                    if goal is not None and acc >= goal:
                        reached = True
                except Exception:  # noqa: BLE001 - a failed trial is a result
                    failed += 1
                    rows.append((f"trial-{i}", i, "accuracy", "unavailable"))
    return rows
