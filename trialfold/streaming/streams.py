"""Structured Streaming operators.

* O90 ``ingest_text_logs``: tailed log folders -> metric rows; each
  micro-batch is written to its own ``batch=<id>`` folder with overwrite,
  so a replayed batch after a failure rewrites instead of duplicating.
* O91 ``incremental_fold``: every micro-batch is folded to its winning rows,
  and these are merged in a logarithmic number of runs (``runs.Runs``), so the
  stream keeps no state of its own and a read folds few rows.
* O92 ``stop_rule_firing``: ``applyInPandasWithState`` keyed by trial; the
  state holds the step count and the met flag per rule, a trial is emitted
  once, when every rule is met.
* O93 ``history_average``: per Succeeded trial the average of its first
  ``start_step`` objective values, final once there are as many; the rule
  value is the mean over ``history_table``.
* O94 ``rolling_gauges``: latest state per trial from a stream of state
  changes, counted by (namespace, state).
* O95 ``split_untimed``: a side table for rows without a time; ``with_lateness``
  sets the event-time watermark where a windowed aggregate follows.

Checkpoints live under the session's shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import json
import operator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from trialfold.functions.exprs import UNAVAILABLE, num, small, time_key
from trialfold.operators import parse
from trialfold.session import cut_lineage
from trialfold.sources.logs import shared_files, tagged_parts
from trialfold.streaming.runs import Runs

WATERMARK = "10 minutes"


def read_log_stream(spark: SparkSession, path: str, max_files: int | None = None, tagged: bool = False) -> DataFrame:
    """O90 source: (trial, line) of text log files, under ``path/trial=<name>/``
    or shared by many trials (``tagged``, as ``write_logs`` makes them)."""
    r = spark.readStream.format("text").option("lineSep", "\n")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    if tagged:
        trial, line = tagged_parts(F.col("value"))
        return r.load(path).select(trial.alias("trial"), line.alias("line"))
    return r.load(path).select("trial", F.col("value").alias("line"))


def parse_stream(lines: DataFrame, trials: DataFrame, experiments: DataFrame, filters=None) -> DataFrame:
    """O90 transform: stream-static joins attach the experiment's metric
    list, then the batch parser (O12–O16) runs unchanged; ``filters`` is one
    list for all experiments or a table (experiment, pos, pattern)."""
    t = lines.join(trials.select("trial", "experiment"), "trial")
    if isinstance(filters, DataFrame):
        return parse.parse_by_filters(parse.attach_metric_lists(t, experiments), filters)
    return parse.parse_text_lines(parse.attach_metric_lists(t, experiments), filters)


def with_lateness(rows: DataFrame, side_path: str | None = None) -> DataFrame:
    """Watermark on ts.  Rows without a time cannot be ordered by event
    time, so ``split_untimed`` routes them to a side table."""
    return rows.withWatermark("ts", WATERMARK)


def split_untimed(batch: DataFrame, side_path: str, batch_id: int) -> DataFrame:
    """Write the rows without a time of one micro-batch to the side table
    and return the timed ones."""
    batch.filter(F.col("ts").isNull()).write.mode("overwrite").parquet(f"{side_path}/batch={batch_id}")
    return batch.filter(F.col("ts").isNotNull())


def ingest_text_logs(spark: SparkSession, src: str, trials: DataFrame, experiments: DataFrame, store: str,
                     side: str, checkpoint: str, max_files: int | None = None, tagged: bool = False):
    """O90 + O95: run the ingest to completion (availableNow).

    A file belongs to one micro-batch, and a line is identified by its batch
    and its place there (``line_no`` grows with the order in a file), so equal
    lines stay apart.  A batch that runs again overwrites its own folders; no
    row is dropped for being late."""
    lines = read_log_stream(spark, src, max_files, tagged)

    def sink(batch: DataFrame, batch_id: int):
        placed = batch.withColumn("line_no", F.monotonically_increasing_id())
        rows = parse_stream(placed, trials, experiments).persist()
        timed = split_untimed(rows, side, batch_id)
        timed.write.mode("overwrite").parquet(f"{store}/batch={batch_id}")
        rows.unpersist()

    q = (lines.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


#: A log row in O91's order: by time, then batch, place in the batch, and match.
_PLACE = ["tk", "batch", "seq", "sub"]


def winning_rows(rows: DataFrame) -> DataFrame:
    """Of each (trial, metric) the rows that its observation needs: the first
    smallest, the first largest and the last one (three at most)."""
    isnum = F.col("x").isNotNull()
    row = F.struct("value", "x", *_PLACE)
    ends = rows.groupBy("trial", "metric").agg(
        F.min_by(row, F.when(isnum, F.struct("x", *_PLACE))).alias("lo"),
        F.max_by(row, F.when(isnum, F.struct(F.col("x"), *[(-F.col(c)).alias(c) for c in _PLACE]))).alias("hi"),
        F.max_by(row, F.struct(*_PLACE)).alias("last"))
    kept = F.array_distinct(F.filter(F.array("lo", "hi", "last"), lambda r: r.isNotNull()))
    return ends.select("trial", "metric", F.explode(kept).alias("r")).select("trial", "metric", "r.*")


def incremental_fold(lines: DataFrame, trials: DataFrame, experiments: DataFrame, trial_metrics: DataFrame, sink_path: str, checkpoint: str, filters=None):
    """min/max/latest per (trial, metric) of a stream of log lines.

    A later line wins among equal times: lines are placed by their batch and
    their order in it.  Every batch is folded to its winning rows, which merge
    as ``Runs``; the streaming query itself holds no state."""
    runs = Runs(lines.sparkSession, sink_path, winning_rows)

    def sink(batch: DataFrame, batch_id: int):
        placed = batch.withColumn("line_no", F.monotonically_increasing_id())
        rows = parse_stream(placed, trials, experiments, filters).join(trial_metrics.select("trial", "metric"), ["trial", "metric"])
        runs.add(rows.select("trial", "metric", "value", num("value").alias("x"), time_key(F.col("ts"), F.col("ts_nanos")).alias("tk"),
                             F.lit(batch_id).cast("long").alias("batch"), "seq", "sub"), batch_id)

    q = (lines.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def fold_state(spark: SparkSession, sink_path: str, trial_metrics: DataFrame) -> DataFrame:
    """O91 as it stands: the live runs folded, unseen metrics 'unavailable'."""
    rows = Runs(spark, sink_path, winning_rows).read()
    names = ["min", "max", "latest"]
    if rows is None:
        return trial_metrics.select("trial", "metric", *[F.lit(UNAVAILABLE).alias(c) for c in names])
    isnum = F.col("x").isNotNull()
    last = rows.groupBy("trial", "metric").agg(
        F.min_by("value", F.when(isnum, F.struct("x", *_PLACE))).alias("min"),
        F.max_by("value", F.when(isnum, F.struct(F.col("x"), *[(-F.col(c)).alias(c) for c in _PLACE]))).alias("max"),
        F.max_by("value", F.struct(*_PLACE)).alias("latest"))
    return (trial_metrics.select("trial", "metric").join(last, ["trial", "metric"], "left")
            .select("trial", "metric", *[F.coalesce(F.col(c), F.lit(UNAVAILABLE)).alias(c) for c in names]))


STOP_OUT = "trial string, stop_seq long, stop_tk long"
STOP_STATE = "counts string, met string, fired boolean"
COMPARISONS = {"equal": operator.eq, "less": operator.lt, "greater": operator.gt}


def _stop_fn(key, pdfs, state):
    """State per trial: rows seen per rule, first hit per rule; emit once,
    when every rule has been met (a rule: its first qualifying hit)."""
    if state.hasTimedOut:
        state.remove()
        return
    if state.exists:
        counts, met, fired = state.get
        counts, met = json.loads(counts), json.loads(met)
    else:
        counts, met, fired = {}, {}, False
    pdf = pd.concat(list(pdfs), ignore_index=True)
    if fired or pdf.empty:
        state.update((json.dumps(counts), json.dumps(met), fired))
        return
    tk, seq = pdf["tk"].to_numpy(), pdf["seq"].to_numpy()
    order = np.lexsort((seq, tk))  # stable
    # plain loops: a trial's rows are too few for a frame operation each
    rules, xs, values = pdf["rule"].tolist(), pdf["x"].tolist(), pdf["rule_value"].astype(float).tolist()
    comparisons, starts = pdf["comparison"].tolist(), pdf["start_step"].tolist()
    for i in order.tolist():
        k = str(rules[i])
        counts[k] = counts.get(k, 0) + 1
        if k not in met and counts[k] >= starts[i]:
            test = COMPARISONS.get(comparisons[i])
            if test and test(xs[i], values[i]):  # false for a missing value
                met[k] = [int(tk[i]), int(seq[i])]
    n_rules = int(pdf["n_rules"].iloc[order[0]])
    out = None
    if len(met) == n_rules:
        fired = True
        last = max(met.values())
        out = pd.DataFrame([(key[0], last[1], last[0])], columns=["trial", "stop_seq", "stop_tk"])
    state.update((json.dumps(counts), json.dumps(met), fired))
    if out is not None:
        yield out


def stop_rule_firing(rows: DataFrame, trials: DataFrame, rules: DataFrame, sink_path: str, checkpoint: str):
    """Rows (trial, ts, seq, metric, value) x the experiment's rules
    (stream-static joins) -> stateful per-trial evaluation."""
    r = small(rules)
    n = r.groupBy("experiment").agg(F.count("*").alias("n_rules"))
    x = (rows.join(trials.select("trial", "experiment"), "trial").join(r, ["experiment", "metric"]).join(small(n), "experiment")
         .select("trial", "rule", "rule_value", "comparison", "start_step", "n_rules",
                 num("value").alias("x"), time_key(F.col("ts")).alias("tk"), "seq"))
    out = x.groupBy("trial").applyInPandasWithState(_stop_fn, STOP_OUT, STOP_STATE, "append", GroupStateTimeout.NoTimeout)

    def sink(batch: DataFrame, batch_id: int):
        batch.write.mode("overwrite").parquet(f"{sink_path}/batch={batch_id}")

    # the stream copies the session's settings as it starts.  Every partition of
    # the state is a task and a file in every batch, so it has as many as the cores use
    spark = rows.sparkSession
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(shared_files(spark)))
    try:
        q = out.writeStream.outputMode("append").foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(
            availableNow=True).start()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    q.awaitTermination()
    return q


def fired(spark: SparkSession, sink_path: str) -> DataFrame:
    """What ``stop_rule_firing`` has emitted; nothing before its first batch."""
    at = spark._jvm.org.apache.hadoop.fs.Path(sink_path)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], STOP_OUT)
    return spark.read.schema(STOP_OUT).parquet(sink_path).select("trial", "stop_seq", "stop_tk")


def history_average(rows: DataFrame, trials_state: DataFrame, experiments: DataFrame, table_path: str, checkpoint: str):
    """Succeeded trials get the average of their first ``start_step``
    objective values.  Each batch keeps the rows that can be among them; a
    trial's average covers those of all batches so far and stands once it has
    ``start_step`` values.  A batch that runs again overwrites its own folders
    and reads earlier batches only; ``history_table`` is the result."""
    spark = rows.sparkSession
    e = experiments.select("experiment", "objective_metric", "ms_start_step")
    seen = f"{table_path}-rows"

    def first_rows(df: DataFrame) -> DataFrame:
        w = Window.partitionBy("trial").orderBy("tk", "batch", "seq")
        return df.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= F.col("ms_start_step")).drop("rn")

    def sink(batch: DataFrame, batch_id: int):
        t = trials_state.filter(F.col("state") == "Succeeded").select("trial", "experiment").join(small(e), "experiment")
        b = batch.join(t, "trial").filter(F.col("metric") == F.col("objective_metric"))
        b = (b.withColumn("x", num("value")).filter(F.col("x").isNotNull()).withColumn("tk", time_key(F.col("ts")))
             .withColumn("batch", F.lit(batch_id)).select("experiment", "trial", "ms_start_step", "tk", "batch", "seq", "x"))
        first_rows(b).drop("batch").write.mode("overwrite").parquet(f"{seen}/batch={batch_id}")
        every = spark.read.parquet(seen).filter(F.col("batch") <= batch_id)
        open_ = every.filter(F.col("batch") == batch_id).select("trial").distinct()
        folder = spark._jvm.org.apache.hadoop.fs.Path(table_path)
        if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
            full = spark.read.parquet(table_path).filter((F.col("batch") < batch_id) & (F.col("n") >= F.col("ms_start_step")))
            open_ = open_.join(full.select("trial"), "trial", "left_anti")
        avg = (first_rows(every.join(open_, "trial", "left_semi")).groupBy("experiment", "trial", "ms_start_step")
               .agg(F.avg("x").alias("avg"), F.count("*").alias("n")))
        cut_lineage(avg).write.mode("overwrite").parquet(f"{table_path}/batch={batch_id}")

    q = rows.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def history_table(spark: SparkSession, table_path: str) -> DataFrame:
    """(experiment, trial, avg) as of the last batch that touched a trial."""
    return (spark.read.parquet(table_path).groupBy("experiment", "trial")
            .agg(F.max_by("avg", "batch").alias("avg")))


def newest_changes(changes: DataFrame) -> DataFrame:
    """The newest change (trial, namespace, state, ord) of each trial."""
    return (changes.groupBy("trial").agg(F.max_by(F.struct("namespace", "state", "ord"), "ord").alias("s"))
            .select("trial", "s.namespace", "s.state", "s.ord"))


def rolling_gauges(changes: DataFrame, sink_path: str, checkpoint: str):
    """Stream of (trial, namespace, state, ord) state changes; each
    batch's newest change per trial goes into merged runs."""
    runs = Runs(changes.sparkSession, sink_path, newest_changes)
    q = (changes.writeStream.foreachBatch(lambda batch, batch_id: runs.add(batch.select("trial", "namespace", "state", "ord"), batch_id))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def gauges_now(spark: SparkSession, sink_path: str) -> DataFrame:
    rows = Runs(spark, sink_path, newest_changes).read()
    if rows is None:
        return spark.createDataFrame([], "namespace string, last_condition string, trials long")
    return newest_changes(rows).groupBy("namespace", F.col("state").alias("last_condition")).agg(F.count("*").alias("trials"))
