"""Observation store append and range read (FIXTURES F5)."""

import uuid

from pyspark.sql import functions as F

from trialfold.session import checkpoint_dir
from trialfold.sources import store


def test_f5_range_read(spark):
    rows = [("test1_trial1", 0, 0, f"2016-12-31T{h}:02:05.123456Z", m, v)
            for h, m, v in [("20", "f1_score", "88.95"), ("20", "loss", "0.5"), ("21", "loss", "0.4"), ("22", "loss", "0.3"),
                            ("23", "loss", "0.2")]]
    df = spark.createDataFrame(rows, "trial string, seq long, sub long, ts_raw string, metric string, value string")
    df = df.withColumn("ts", F.to_timestamp("ts_raw")).withColumn("ts_nanos", F.lit(123456000))
    p = f"{checkpoint_dir(spark)}/test-store-{uuid.uuid4().hex}"
    store.append_observations(df, p)
    s = store.read_store(spark, p)
    r = store.range_read_one(s, "test1_trial1", "loss", "2016-12-31T21:01:05.123456Z", "2016-12-31T22:10:20.123456Z")
    assert [x.value for x in r.collect()] == ["0.4", "0.3"]
    gone = store.delete_trials(s, spark.createDataFrame([("test1_trial1",)], "trial string"))
    assert gone.count() == 0


def test_delete_rewrites_only_touched_partitions(spark):
    rows = [("a", 0, 0, "2024-01-01T00:00:00Z", "m", "1"), ("b", 1, 0, "2024-01-01T01:00:00Z", "m", "2"),
            ("c", 2, 0, "2024-01-02T00:00:00Z", "m", "3")]
    df = spark.createDataFrame(rows, "trial string, seq long, sub long, ts_raw string, metric string, value string")
    df = df.withColumn("ts", F.to_timestamp("ts_raw")).withColumn("ts_nanos", F.lit(0))
    p = f"{checkpoint_dir(spark)}/test-store-{uuid.uuid4().hex}"
    store.append_observations(df, p)
    store.delete_and_rewrite(spark, p, spark.createDataFrame([("a",)], "trial string"))
    assert sorted(r.trial for r in store.read_store(spark, p).collect()) == ["b", "c"]


def test_delete_empties_a_wholly_doomed_day(spark):
    rows = [("a", 0, 0, "2024-01-01T00:00:00Z", "m", "1"), ("b", 1, 0, "2024-01-02T01:00:00Z", "m", "2")]
    df = spark.createDataFrame(rows, "trial string, seq long, sub long, ts_raw string, metric string, value string")
    df = df.withColumn("ts", F.to_timestamp("ts_raw")).withColumn("ts_nanos", F.lit(0))
    p = f"{checkpoint_dir(spark)}/test-store-{uuid.uuid4().hex}"
    store.append_observations(df, p)
    store.delete_and_rewrite(spark, p, spark.createDataFrame([("a",)], "trial string"))
    assert [r.trial for r in store.read_store(spark, p).collect()] == ["b"]


def _store(spark, rows):
    df = spark.createDataFrame(rows, "trial string, seq long, sub long, ts_raw string, metric string, value string")
    df = df.withColumn("ts", F.to_timestamp("ts_raw")).withColumn("ts_nanos", F.lit(0))
    p = f"{checkpoint_dir(spark)}/test-store-{uuid.uuid4().hex}"
    store.append_observations(df, p)
    return df, p


ROWS = [(t, i, 0, f"2024-01-{1 + i % 5:02d}T00:00:{i:02d}Z", "m", str(i)) for i, t in enumerate("abcabcabcabcabc")]


def _trials(spark, p):
    return sorted((r.trial, r.seq) for r in store.read_store(spark, p).collect())


def test_a_write_that_dies_half_way_leaves_the_table(spark, monkeypatch):
    df, p = _store(spark, ROWS)
    before, old = _trials(spark, p), store.read_store(spark, p)
    doomed = spark.createDataFrame([("a",)], "trial string")

    def dies(*_):
        raise RuntimeError("executor and driver are gone")

    with monkeypatch.context() as m:
        m.setattr(store, "_commit", dies)
        for write in (lambda: store.delete_and_rewrite(spark, p, doomed), lambda: store.append_observations(df, p)):
            try:
                write()
            except RuntimeError:
                pass
    assert _trials(spark, p) == before  # new files lie there, no manifest names them
    store.delete_and_rewrite(spark, p, doomed)
    assert _trials(spark, p) == [x for x in before if x[0] != "a"]
    assert sorted((r.trial, r.seq) for r in old.collect()) == before  # a reader keeps its snapshot
    store.append_observations(df.filter("trial = 'a'"), p)
    assert _trials(spark, p) == before
    store.expire(spark, p)
    assert _trials(spark, p) == before


def test_a_snapshot_is_committed_once(spark):
    _, p = _store(spark, ROWS)
    folders = store.snapshot(spark, p)
    store._commit(spark, p, folders)
    assert store.snapshot(spark, p) == folders and store._last(spark, p) == 2


def test_bulk_ranges_prune_days_and_keep_the_order(spark):
    _, p = _store(spark, ROWS)
    table = store.read_store(spark, p)
    req = spark.createDataFrame([("r1", "a", None, "2024-01-01 00:00:00", "2024-01-02 23:00:00"), ("r2", "b", "m", "2024-01-03 00:00:00", None),
                                 ("r3", "c", "other", None, None), ("r4", "c", None, None, "2024-01-01 00:00:30"), ("r5", "c", None, "2024-02-01 00:00:00", "2024-01-01 00:00:00")],
                                "req string, trial string, req_metric string, start string, end string")
    req = req.withColumns({"start": F.to_timestamp("start"), "end": F.to_timestamp("end")})
    out = store.range_read(table, req)
    want = []
    for r in req.collect():
        mine = [x for x in table.collect() if x.trial == r.trial and (r.req_metric is None or x.metric == r.req_metric)
                and (r.start is None or x.ts >= r.start) and (r.end is None or x.ts <= r.end)]
        want += [(r.req, x.seq) for x in sorted(mine, key=lambda x: (x.ts, x.seq))]
    assert [(r.req, r.seq) for r in out.collect()] == want and want
    # (trial, day) joins prune the days that no request asks for
    wide = spark.createDataFrame([("q", "a", None, "2024-01-02 00:00:00", "2024-01-02 23:00:00")], "req string, trial string, req_metric string, start string, end string")
    plan = store.range_read(table, wide.withColumns({"start": F.to_timestamp("start"), "end": F.to_timestamp("end")}))._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


def test_requests_by_day_are_never_broadcast(spark):
    """Days multiply the requests after any size estimate, so their table is shuffled; only the distinct days are broadcast."""
    _, p = _store(spark, ROWS)
    req = spark.range(4).select(F.concat(F.lit("r"), "id").alias("req"), F.lit("a").alias("trial"), F.lit(None).cast("string").alias("req_metric"),
                                F.to_timestamp(F.lit("2024-01-01 00:00:00")).alias("start"), F.to_timestamp(F.lit("2024-01-20 00:00:00")).alias("end"))
    out = store.range_read(store.read_store(spark, p), req.repartition(2))
    assert {r.req for r in out.collect()} == {"r0", "r1", "r2", "r3"}
    plan = out._jdf.queryExecution().executedPlan().toString()
    by_day = [line for line in plan.splitlines() if "Join" in line and "day#" in line and "LeftSemi" not in line]
    assert by_day and all("SortMergeJoin" in line for line in by_day), plan
