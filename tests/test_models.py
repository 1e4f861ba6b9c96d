"""Spark ML fits on the cleaned split: runnable, scored, tuned."""

from pyspark.sql import functions as F

from trialfold.operators import features as fe
from trialfold.operators import models
from trialfold.plans import views


def _split(spark, d):
    s = fe.exact_split(fe.clean(views.dataset(spark, d))).filter(F.col(fe.LABEL).isNotNull())
    return s.filter(~F.col("is_test")), s.filter("is_test")


def test_models_score(spark, sf_dir):
    tr, te = _split(spark, sf_dir)
    for m in [models.train_gbt(tr, te, 0.3, 5), models.train_forest(tr, 5), models.train_logistic(tr, 10)]:
        acc = models.accuracy(m, te)
        assert 0.5 <= acc <= 1.0


def test_tune_writes_metric_log(spark, sf_dir):
    tr, te = _split(spark, sf_dir)

    def objective(train, test, p):
        if p["fail"]:
            raise ValueError("bad trial")
        return 0.5

    rows = models.tune(spark, tr, te, [{"fail": False}, {"fail": True}, {"fail": False}], objective,
                       max_trials=3, max_failed=1, parallel=1, goal=None).collect()
    assert [(r.trial, r.value) for r in rows] == [("trial-0", "0.5"), ("trial-1", "unavailable")]


def test_exact_split_size(spark, sf_dir):
    s = fe.exact_split(fe.clean(views.dataset(spark, sf_dir)))
    n = s.count()
    assert s.filter("is_test").count() == -(-n * 2 // 10)


def test_a_fit_and_its_losses_compute_the_rows_once(spark, sf_dir):
    """Boosting passes over kept rows; what is before the fit runs once a row, not once a pass."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(x):
        made.add(1)
        return x

    rows = spark.range(400).select(F.col("id").alias("id"), (F.col("id") % 2).cast("int").alias("gender"),
                                   *[(F.col("id") % m).cast("double").alias(c) for c, m in zip(fe.NUMERIC, (60, 25, 5, 220))],
                                   (F.col("id") % 5 > 2).cast("int").alias(fe.LABEL))
    rows = rows.withColumn("age", counted.asNondeterministic()("age"))
    train, test = rows.filter("id >= 100"), rows.filter("id < 100")
    m = models.train_gbt(train, test, 0.1, 5)
    fit = made.value
    assert len(models.loss_curve(m, test, every=1)) >= 1
    assert fit <= 2 * 400 and made.value - fit <= 400, (fit, made.value)
