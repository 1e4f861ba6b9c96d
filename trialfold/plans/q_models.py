"""Registered queries: model training, tuning and kNN."""

from __future__ import annotations

from pyspark.sql import functions as F

from trialfold.functions.exprs import md5_uniform
from trialfold.operators import features as fe
from trialfold.operators import fold, knn, models
from trialfold.plans import views
from trialfold.plans.catalog import register
from trialfold.plans.q_sources import scratch
from trialfold.sources import files


def _split(spark, d):
    s = fe.exact_split(fe.clean(views.dataset(spark, d))).filter(F.col(fe.LABEL).isNotNull())
    return s.filter(~F.col("is_test")), s.filter("is_test")


def _weight(train) -> float:
    return float(fe.class_weight(train).collect()[0][0])  # one aggregate value


@register("o78_boosted_trees_train")
def q_gbt(spark, d):
    tr, te = _split(spark, d)
    m = models.train_gbt(tr, te, learning_rate=0.1, n_estimators=10, scale_pos_weight=_weight(tr))
    return fe.round_and_score(models.predict(m, te)).withColumn("model", F.lit("boosted_trees"))


@register("o79_random_forest_train")
def q_rf(spark, d):
    tr, te = _split(spark, d)
    m = models.train_forest(tr, n_estimators=10)
    return fe.round_and_score(models.predict(m, te)).withColumn("model", F.lit("random_forest"))


@register("o81_logistic_regression_train")
def q_lr(spark, d):
    tr, te = _split(spark, d)
    m = models.train_logistic(tr, max_iter=20)
    return fe.round_and_score(models.predict(m, te)).withColumn("model", F.lit("logistic_regression"))


def _knn_sets(spark, d):
    e = views.table(spark, d, "embeddings")
    t = md5_uniform(F.lit("knn"), F.col("vec_id")) < 0.2
    return e.filter(~t), e.filter(t)


@register("o80_knn_classify", """
SELECT qid AS vec_id, arg_max(label, {'n': n, 'neg': -label}) AS prediction FROM (
  SELECT qid, label, count(*) AS n FROM (
    SELECT q.vec_id AS qid, r.label,
      row_number() OVER (PARTITION BY q.vec_id ORDER BY sqrt(list_reduce(list_transform(range(1, len(q.embedding) + 1),
        lambda i: (CAST(q.embedding[i] AS DOUBLE) - CAST(r.embedding[i] AS DOUBLE))
                * (CAST(q.embedding[i] AS DOUBLE) - CAST(r.embedding[i] AS DOUBLE))), lambda a, b: a + b)), r.vec_id) AS rn
    FROM (SELECT * FROM embeddings WHERE (('0x' || substr(md5(concat_ws('|', 'knn', vec_id)), 1, 8))::BIGINT / 4294967296.0) < 0.2) q,
         (SELECT * FROM embeddings WHERE NOT ((('0x' || substr(md5(concat_ws('|', 'knn', vec_id)), 1, 8))::BIGINT / 4294967296.0) < 0.2)) r)
  WHERE rn <= 5 GROUP BY qid, label) GROUP BY qid""")
def q_knn(spark, d):
    refs, qs = _knn_sets(spark, d)
    return knn.knn_classify(refs, qs, k=5)


def _objective(train, test, p):
    m = models.train_gbt(train, test, learning_rate=p["lr"], n_estimators=p["ne"])
    return models.accuracy(m, test)


@register("o83_tuning_sweep")
def q_tune(spark, d):
    tr, te = _split(spark, d)
    grid = [{"lr": 0.1, "ne": 5}, {"lr": 0.3, "ne": 5}, {"lr": 0.2, "ne": 8}]
    rows = models.tune(spark, tr, te, grid, _objective, max_trials=3, max_failed=3, parallel=2, goal=0.99)
    tm = rows.select("trial").distinct().withColumn("metric", F.lit("accuracy")).withColumn("strategy", F.lit("max"))
    obs = rows.withColumn("ts", F.lit(None).cast("timestamp"))
    return fold.fold_observations(obs, tm)


@register("o85_loss_curve")
def q_loss_curve(spark, d):
    tr, te = _split(spark, d)
    m = models.train_gbt(tr, te, learning_rate=0.1, n_estimators=20)
    pts = models.loss_curve(m, te, every=5)
    return spark.createDataFrame([("trial-gbt", i, "loss", repr(v)) for i, v in pts],
                                 "trial string, seq long, metric string, value string")


@register("o09_result_sink")
def q_sink(spark, d):
    tr, te = _split(spark, d)
    m = models.train_forest(tr, n_estimators=5)
    p = scratch(spark, "models")
    m.write().overwrite().save(f"{p}/model/random_forest")
    res = fe.round_and_score(models.predict(m, te)).select(
        F.lit("random_forest").alias("model"), "accuracy", F.lit(f"{p}/model/random_forest").alias("model_path"))
    files.write_results(res, f"{p}/results")
    return spark.read.json(f"{p}/results")

