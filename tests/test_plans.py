"""Plan shape: partial aggregation before the shuffle, pruned scans,
pushed filters, salted top-k, hot-key correctness."""

from pyspark.sql import functions as F

from trialfold.operators import fold, state
from trialfold.plans import views
from trialfold.sources import store


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_fold_aggregates_before_shuffle(spark, sf_dir):
    obs = views.obs(spark, sf_dir)
    tm = spark.createDataFrame([("trial-1", "purchase")], "trial string, metric string")
    p = _plan(fold.fold_observations(obs, tm))
    assert "partial_min_by" in p and "partial_max_by" in p


def test_range_read_pushes_filters(spark, sf_dir):
    q = store.range_read_one(views.table(spark, sf_dir, "events").withColumnRenamed("user_id", "u")
                             .select(F.concat(F.lit("trial-"), F.col("u").cast("string")).alias("trial"),
                                     F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("seq"),
                                     F.lit(0).alias("sub"), F.col("event_type").alias("metric")),
                             "trial-1", "purchase")
    p = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in p and "EqualTo(event_type,purchase)" in p
    assert "props" not in p.split("ReadSchema")[1].split("\n")[0]  # unused column pruned


def test_hot_trial_fold_is_correct(spark):
    rows = [("hot", i, f"{i % 97}.5") for i in range(3000)] + [(f"t{i}", i, "1.0") for i in range(3000)]
    df = spark.createDataFrame(rows, "trial string, seq long, value string").withColumn(
        "metric", F.lit("m")).withColumn("ts", F.timestamp_seconds(F.col("seq")))
    tm = spark.createDataFrame([("hot", "m"), ("t1", "m")], "trial string, metric string")
    got = {r.trial: (r.min, r.max, r.latest) for r in fold.fold_observations(df.repartition(16), tm).collect()}
    assert got["hot"] == ("0.5", "96.5", f"{2999 % 97}.5") and got["t1"] == ("1.0", "1.0", "1.0")


def test_salted_top_k_shuffles_on_salt(spark):
    df = spark.range(0, 1000).select(F.lit("g").alias("g"), F.col("id"))
    p = _plan(state.top_k_per_group(df, ["g"], [F.col("id")], F.lit(3), salts=8))
    assert "_salt" in p


def test_flagship_parses_the_log_once(spark, sf_dir):
    from trialfold.plans.pipelines import flagship
    scans = [line for line in _plan(flagship(spark, sf_dir)).split("\n") if "FileScan" in line and "event_id" in line]
    assert len(scans) == 1
