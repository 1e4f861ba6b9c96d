"""Streaming operators agree with their batch twins."""

import os
import random

from pyspark.sql import functions as F

import __spark_entry__ as E
from trialfold.operators import guide
from trialfold.plans import views
from trialfold.plans.pipelines import Ctx


def test_stop_rule_firing_matches_batch(spark, sf_dir):
    s = E.queries()["o92_stop_rule_firing"](spark, sf_dir)
    c = Ctx(spark, sf_dir)
    b = guide.evaluate_stop_rules(c.obs, c.trials, views.stop_rules(spark, sf_dir)).filter("stopped")
    assert sorted((r.trial, r.stop_seq) for r in s.collect()) == sorted((r.trial, r.stop_seq) for r in b.collect())


def test_incremental_fold_matches_batch(spark, sf_dir):
    s = E.queries()["o91_incremental_fold"](spark, sf_dir)
    c = Ctx(spark, sf_dir)
    from trialfold.operators import fold, parse
    lines = parse.attach_metric_lists(views.log_lines(spark, sf_dir), c.experiments)
    b = fold.fold_observations(parse.parse_text_lines(lines), c.trial_metrics)
    assert sorted(s.collect()) == sorted(b.collect())


def _split_logs(spark, path, rnd):
    """Logs of trials over several files each, with equal times, equal lines and lines without a time."""
    lines = {}
    for t in ("trial-1", "trial-2", "trial-3"):
        mine = [f"2024-01-01T00:00:{rnd.randrange(3):02d}Z purchase={rnd.randrange(50)}.5" if rnd.random() < 0.8 else f"purchase={rnd.randrange(50)}" for _ in range(60)]
        lines[t] = mine + mine[-3:]
    for part in range(4):
        for t, all_ in lines.items():
            some = all_[part * 16:(part + 1) * 16]
            spark.createDataFrame([(x,) for x in some], "value string").coalesce(1).write.mode("append").text(f"{path}/trial={t}")
    return lines


def test_ingest_in_many_batches_keeps_every_row(spark, sf_dir):
    from trialfold.plans import q_stream
    from trialfold.streaming import streams

    c, src = Ctx(spark, sf_dir), q_stream.scratch(spark, "split-logs")
    _split_logs(spark, src, random.Random(1))
    trials = spark.createDataFrame([(f"trial-{i}", "exp-0") for i in (1, 2, 3)], "trial string, experiment string")
    found = []
    for most in (None, 1, 5):
        root = q_stream.scratch(spark, "ingest-test")
        streams.ingest_text_logs(spark, src, trials, c.experiments, f"{root}/store", f"{root}/side", f"{root}/ckpt", most)
        found.append([sorted(map(str, spark.read.parquet(f"{root}/{part}").select("trial", "sub", "ts_raw", "ts", "metric", "value").collect())) for part in ("store", "side")])
    assert found[0] == found[1] == found[2] and all(found[0])


def test_fold_of_split_trials_in_any_batches(spark, sf_dir):
    """Files in order of time of change, so the last line of a trial is in its last file."""
    from trialfold.operators import fold, parse
    from trialfold.plans import q_stream
    from trialfold.streaming import runs, streams

    c, src = Ctx(spark, sf_dir), q_stream.scratch(spark, "split-fold")
    lines = _split_logs(spark, src, random.Random(2))
    trials = spark.createDataFrame([(f"trial-{i}", "exp-0") for i in (1, 2, 3)], "trial string, experiment string")
    metrics = trials.select("trial", F.lit("purchase").alias("metric"))
    log = spark.createDataFrame([(t, i, x, "exp-0") for t, all_ in lines.items() for i, x in enumerate(all_[:64])], "trial string, line_no long, line string, experiment string")
    want = sorted(fold.fold_observations(parse.parse_text_lines(parse.attach_metric_lists(log, c.experiments)), metrics).collect())
    root = q_stream.scratch(spark, "fold-test")
    streams.incremental_fold(streams.read_log_stream(spark, src, 1), trials, c.experiments, metrics, f"{root}/state", f"{root}/ckpt")
    got = sorted(streams.fold_state(spark, f"{root}/state", metrics).collect())
    assert [(r.trial, r.min, r.max, r.latest) for r in got] == [(r.trial, r.min, r.max, r.latest) for r in want]
    kept = runs.Runs(spark, f"{root}/state", streams.winning_rows)
    assert kept.batches() == 12 and len(runs.live(12)) == 2 and kept.read().count() <= 2 * 3 * 3


def test_runs_stay_few_and_replay_changes_nothing(spark):
    from trialfold.plans.q_stream import scratch
    from trialfold.streaming.runs import Runs, live

    assert live(13) == [(0, 8), (8, 12), (12, 13)] and live(0) == []

    def reduce(rows):
        return rows.groupBy("k").agg(F.sum("n").alias("n"))

    path, want = scratch(spark, "runs"), {}
    held = Runs(spark, path, reduce)
    assert held.read() is None
    for b in range(11):
        batch = spark.createDataFrame([(b % 3, 1), (7, 1)], "k long, n long")
        for _ in range(2 if b in (3, 7) else 1):  # a batch that was cut short runs again
            held.add(batch, b)
        want[b % 3] = want.get(b % 3, 0) + 1
        want[7] = want.get(7, 0) + 1
        total = {r["k"]: r["n"] for r in reduce(held.read()).collect()}
        assert total == want
        assert len(held.read().inputFiles()) <= 8 * len(live(b + 1))
    assert held.batches() == 11


def _files(path, ending):
    return [f for f in os.listdir(path) if f.endswith(ending)]


def test_shared_logs_keep_every_line_in_few_files(spark):
    """Files don't grow with the trials; breaks, tabs, empty lines and the order inside a trial survive."""
    from trialfold.plans.q_stream import scratch
    from trialfold.sources import logs
    from trialfold.streaming import streams

    special = [("t-x", 3, "c\td"), ("t-x", 1, "a\nb\n"), ("t-x", 2, None), ("t-x", 4, "")]
    rows = special + [(f"t-{i}", 1, f"line {i}") for i in range(300)]
    p = logs.write_logs(spark.createDataFrame(rows, "trial string, line_no long, line string").repartition(3), scratch(spark, "shared"))
    assert len(_files(p, ".txt")) <= logs.shared_files(spark) and not any("=" in f for f in os.listdir(p))
    back = logs.read_logs(spark, p, tagged=True).orderBy("file", "block", "line_no").collect()
    assert [r.line for r in back if r.trial == "t-x"] == ["a", "b", "", "", "c\td", ""]
    assert sorted((r.trial, r.line) for r in back if r.trial != "t-x") == sorted((t, x) for t, _, x in rows if t != "t-x")
    seen = []
    q = streams.read_log_stream(spark, p, 2, tagged=True).writeStream.foreachBatch(lambda b, i: seen.extend(map(tuple, b.collect()))).option(
        "checkpointLocation", scratch(spark, "shared-ckpt")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(seen) == sorted((r.trial, r.line) for r in back)


def test_streamed_metric_log_has_few_files_and_batches(spark, sf_dir):
    from trialfold.plans import q_stream
    from trialfold.sources import logs

    p = q_stream._obs_dir(spark, sf_dir)
    assert 1 <= len(_files(p, ".parquet")) <= logs.shared_files(spark)
    files = spark.read.parquet(p).select("trial", F.input_file_name().alias("f")).distinct()
    assert files.groupBy("trial").count().filter("count > 1").isEmpty()  # a trial is evaluated whole
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    E.queries()["o92_stop_rule_firing"](spark, sf_dir)
    assert spark.conf.get("spark.sql.shuffle.partitions") == partitions


def test_a_stop_rule_goes_on_counting_in_the_next_batch():
    import numpy as np
    import pandas as pd

    from trialfold.streaming import streams

    class State:
        exists, hasTimedOut, get = False, False, None

        def update(self, new):
            self.exists, self.get = True, new

    def batch(rows):
        return pd.DataFrame([(0, "5", "greater", 2, 1, x, tk, seq) for x, tk, seq in rows],
                            columns=["rule", "rule_value", "comparison", "start_step", "n_rules", "x", "tk", "seq"])

    state = State()
    assert list(streams._stop_fn(("t",), iter([batch([(9.0, 1, 0)])]), state)) == []
    out = list(streams._stop_fn(("t",), iter([batch([(8.0, 3, 4), (np.nan, 2, 2), (7.0, 3, 3)])]), state))
    assert [tuple(r) for r in out[0].itertuples(index=False)] == [("t", 3, 3)]
    assert list(streams._stop_fn(("t",), iter([batch([(9.0, 5, 6)])]), state)) == []
