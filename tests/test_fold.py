"""Observation fold and strategy pick."""

from pyspark.sql import functions as F

from trialfold.functions.exprs import num, rfc3339_parts
from trialfold.operators import fold

#: (time, metric, value): out of order, two rows at the last time, zones that differ, a text among numbers.
SERIES = [("2023-06-01T10:00:05Z", "loss", "4.5"), ("2023-06-01T10:00:01Z", "loss", "9"), ("2023-06-01T12:00:09+02:00", "loss", "-2e0"),
          ("2023-06-01T10:00:09Z", "loss", "3.25"), ("2023-06-01T10:00:07Z", "loss", "n/a"),
          ("2023-06-01T10:00:02Z", "recall", "0.125"), ("2023-06-01T09:00:08-01:00", "recall", "0.5"), ("2023-06-01T10:00:03Z", "recall", "0.875")]


def _obs(spark):
    rows = [("t1", i, ts, m, v) for i, (ts, m, v) in enumerate(SERIES)]
    df = spark.createDataFrame(rows, "trial string, seq long, ts_raw string, metric string, value string")
    ts, nanos = rfc3339_parts(F.col("ts_raw"))
    return df.withColumn("ts", ts).withColumn("ts_nanos", nanos)


def _tm(spark, metrics):
    return spark.createDataFrame([("t1", m, "min") for m in metrics], "trial string, metric string, strategy string")


def test_fold(spark):
    r = {x.metric: (x.min, x.max, x.latest) for x in fold.fold_observations(_obs(spark), _tm(spark, ["loss", "recall", "unseen"])).collect()}
    assert r["loss"] == ("-2e0", "9", "3.25")  # of equal times the later row
    assert r["recall"] == ("0.125", "0.875", "0.5")
    assert r["unseen"] == ("unavailable", "unavailable", "unavailable")


def test_fold_partition_independent(spark):
    a = sorted(fold.fold_observations(_obs(spark).repartition(1), _tm(spark, ["loss", "recall"])).collect())
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        b = sorted(fold.fold_observations(_obs(spark).repartition(7), _tm(spark, ["loss", "recall"])).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert a == b


def test_strategy_pick(spark):
    rows = [(strategy, lo, hi, "5", {"min": lo, "max": hi, "latest": "5"}[strategy] if "unavailable" not in (lo, hi) or strategy == "latest"
             else "5" if {"min": lo, "max": hi}[strategy] == "unavailable" else {"min": lo, "max": hi}[strategy])
            for strategy in ("min", "max", "latest") for lo in ("2", "unavailable") for hi in ("7", "unavailable")]
    df = spark.createDataFrame(rows, "strategy string, min string, max string, latest string, expected string")
    got = df.select(fold.pick(F.col("strategy"), F.col("min"), F.col("max"), F.col("latest")).alias("v"), "expected").collect()
    assert len(got) == 12 and all(r.v == r.expected for r in got)


def test_numeric_guard(spark):
    from trialfold.functions.exprs import num
    df = spark.createDataFrame([("1d",), (" 1",), ("NaN",), ("1e5",), (".5",)], "v string")
    assert [r.x for r in df.select(num("v").alias("x")).collect()] == [None, None, None, 100000.0, 0.5]


def test_number_texts(spark):
    """Infinities and hexadecimal floats are numbers, what 64 bits can't hold isn't."""
    texts = {"inf": float("inf"), "-Infinity": float("-inf"), "+INF": float("inf"), "1e400": None, "-1e999": None, "0x1.8p3": 12.0,
             "-0X.8P1": -1.0, "0x10": None, "NaN": None, "12d": None, "1f": None, " 1": None, "+.5": 0.5, "5.": 5.0, "": None, "infinit": None, "1e-400": 0.0}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r.t: r.x for r in df.select("t", num("t").alias("x")).collect()} == texts


def test_last_listed_value_is_the_last_in_the_list(spark):
    tm = spark.createDataFrame([("t1", 0, "loss", "min"), ("t1", 1, "recall", "max"), ("t1", 2, "loss", "latest")],
                               "trial string, pos int, metric string, strategy string")
    trials = spark.createDataFrame([("t1", "e")], "trial string, experiment string")
    exps = spark.createDataFrame([("e", "loss")], "experiment string, objective_metric string")
    folded = fold.fold_observations(_obs(spark), tm.select("trial", "metric").distinct())
    got = fold.last_listed_value(fold.picked_values(folded, tm, listed=True), trials, exps).collect()
    assert [(r.value, r.parse_error) for r in got] == [(3.25, False)]


def test_bad_times(spark):
    times = ["2023-06-01T10:00:05Z", "2023-06-01 10:00:05", "2023-13-01T10:00:05Z", "", None, "0001-01-01T00:00:00Z", "2023-06-01T10:00:05"]
    df = spark.createDataFrame([("t", i, "loss", t) for i, t in enumerate(times)], "trial string, seq long, metric string, ts_raw string")
    assert sorted(r.seq for r in fold.bad_times(df).collect()) == [1, 2, 6]
