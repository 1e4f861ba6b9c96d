"""Trial state, verdict and skew-safe top-k."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from trialfold.operators import state


def test_state_precedence(spark):
    rows = [("t1", [("Running", "True"), ("Failed", "True"), ("Killed", "True")]),
            ("t2", [("Succeeded", "True"), ("EarlyStopped", "True")]),
            ("t3", [("Created", "True"), ("Running", "False")]),
            ("t4", [])]
    df = spark.createDataFrame(rows, "trial string, conditions array<struct<type:string,status:string>>")
    got = {r.trial: (r.state, r.last) for r in state.classify_trials(df).select(
        "trial", "state", state.last_condition(F.col("conditions")).alias("last")).collect()}
    assert got == {"t1": ("Killed", "Killed"), "t2": ("Succeeded", "EarlyStopped"), "t3": ("Pending", "Running"),
                   "t4": ("Pending", "Unknown")}


def test_top_k_matches_plain_window(spark):
    df = spark.range(0, 2000).select((F.col("id") % 3).cast("string").alias("g"), F.col("id"),
                                     ((F.col("id") * 7919) % 1000).alias("v"))
    k = F.lit(17)
    a = state.top_k_per_group(df, ["g"], [F.col("v").desc(), F.col("id")], k, salts=8).select("g", "id", "rank")
    w = Window.partitionBy("g").orderBy(F.col("v").desc(), F.col("id"))
    b = df.withColumn("rank", F.row_number().over(w)).filter("rank <= 17").select("g", "id", "rank")
    assert sorted(a.collect()) == sorted(b.collect())


def test_verdict_ladder(spark):
    summ = spark.createDataFrame([("e1", 5, 0, 1, 2, 0, 0, 2, 0), ("e2", 5, 0, 0, 1, 0, 2, 0, 2)],
                                 "experiment string, trials long, trials_killed long, trials_failed long, "
                                 "trials_succeeded long, trials_early_stopped long, trials_running long, "
                                 "trials_metrics_unavailable long, trials_pending long")
    best = spark.createDataFrame([("e1", False, None, None), ("e2", True, "t", "1")],
                                 "experiment string, goal_reached boolean, best_trial string, best_value string")
    exps = spark.createDataFrame([("e1", 10, 3, False), ("e2", 10, 3, False)],
                                 "experiment string, max_trial_count int, max_failed_trial_count int, suggestions_ended boolean")
    got = {r.experiment: r.reason for r in state.verdict(summ, best, exps).collect()}
    assert got == {"e1": "ExperimentFailed", "e2": "ExperimentGoalReached"}
