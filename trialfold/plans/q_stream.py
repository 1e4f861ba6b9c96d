"""Registered queries: streaming operators (O90–O95), each run to completion
with an ``availableNow`` trigger over files Spark derives from the given
tables, then read back from its sink."""

from __future__ import annotations

from pyspark.sql import functions as F

from trialfold.functions.exprs import ts_text
from trialfold.plans import views
from trialfold.plans.catalog import TEXT_ROWS, register
from trialfold.plans.oracle import VIEWS, num_sql, tk_sql, with_views
from trialfold.plans.pipelines import Ctx
from trialfold.plans.q_sources import scratch
from trialfold.sources import logs
from trialfold.streaming import streams

OBS_SCHEMA = "trial string, seq long, ts timestamp, metric string, value string"


def _log_dir(spark, d):
    p = scratch(spark, "stream-logs")
    logs.write_logs(views.log_lines(spark, d), p)
    return p


def _batch_files(spark):
    """Files a micro-batch, for several batches whatever the number of trials."""
    return max(1, logs.shared_files(spark) // 8)


def _ingest(spark, d):
    c = Ctx(spark, d)
    src, root = _log_dir(spark, d), scratch(spark, "ingest")
    streams.ingest_text_logs(spark, src, c.trials, c.experiments, f"{root}/store", f"{root}/side", f"{root}/ckpt", tagged=True)
    return root


def _text_sql(body: str, extra=None) -> str:
    return with_views(body, "log_lines", "experiments", "trials", extra=TEXT_ROWS + (extra or []))


@register("o90_stream_log_ingest", _text_sql("SELECT trial, sub, ts_raw, ts, metric, value FROM parsed WHERE ts IS NOT NULL"))
def q_ingest(spark, d):
    root = _ingest(spark, d)
    s = spark.read.parquet(f"{root}/store")
    return s.select("trial", "sub", "ts_raw", ts_text(F.col("ts")).alias("ts"), "metric", "value")


@register("o95_untimed_side_table", _text_sql("SELECT trial, sub, ts_raw, metric, value FROM parsed WHERE ts IS NULL"))
def q_side(spark, d):
    root = _ingest(spark, d)
    return spark.read.parquet(f"{root}/side").select("trial", "sub", "ts_raw", "metric", "value")


@register("o91_incremental_fold", _text_sql(f"""
SELECT tm.trial, tm.metric, coalesce(a.min, 'unavailable') AS min, coalesce(a.max, 'unavailable') AS max,
       coalesce(a.latest, 'unavailable') AS latest
FROM tm LEFT JOIN (
  SELECT trial, metric,
    arg_min(value, row(num, tk, sub)) FILTER (WHERE num IS NOT NULL) AS min,
    arg_max(value, row(num, -tk, -sub)) FILTER (WHERE num IS NOT NULL) AS max,
    arg_max(value, row(tk, sub)) AS latest
  FROM (SELECT trial, metric, value, {num_sql('value')} AS num, {tk_sql('CAST(ts AS TIMESTAMP)')} AS tk, sub FROM parsed)
  GROUP BY trial, metric) a USING (trial, metric)""", extra=[
    ("strategies", VIEWS["strategies"][0]),
    ("tm", "SELECT t.trial, s.metric FROM trials t JOIN strategies s USING (experiment)")]))
def q_incremental_fold(spark, d):
    c = Ctx(spark, d)
    src, root = _log_dir(spark, d), scratch(spark, "fold")
    streams.incremental_fold(streams.read_log_stream(spark, src, _batch_files(spark), tagged=True), c.trials, c.experiments, c.trial_metrics, f"{root}/state", f"{root}/ckpt")
    return streams.fold_state(spark, f"{root}/state", c.trial_metrics)


def _obs_dir(spark, d):
    """The metric log in files that many trials share; a trial is in one file."""
    p = scratch(spark, "stream-obs")
    views.obs(spark, d).repartition(logs.shared_files(spark), "trial").write.parquet(p)
    return p


def _obs_stream(spark, p, max_files=None):
    r = spark.readStream.schema(OBS_SCHEMA)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(p)


def _stop_rules_sql() -> str:
    from trialfold.plans.catalog import ORACLE
    return f"SELECT trial, stop_seq FROM ({ORACLE['o56h_stop_rule_evaluation']}) WHERE stopped"


@register("o92_stop_rule_firing", _stop_rules_sql())
def q_stop_firing(spark, d):
    c = Ctx(spark, d)
    root = scratch(spark, "stop")
    s = _obs_stream(spark, _obs_dir(spark, d), max_files=_batch_files(spark))
    streams.stop_rule_firing(s, c.trials, views.stop_rules(spark, d), f"{root}/out", f"{root}/ckpt")
    return streams.fired(spark, f"{root}/out").select("trial", "stop_seq")


@register("o93_history_average", with_views(f"""
SELECT experiment, trial, round(avg(x), 9) AS avg FROM (
  SELECT o.trial, t.experiment, {num_sql('o.value')} AS x, e.ms_start_step,
    row_number() OVER (PARTITION BY o.trial ORDER BY {tk_sql('o.ts')}, o.seq) AS rn
  FROM obs o JOIN trials_state t USING (trial) JOIN experiments e ON e.experiment = t.experiment
  WHERE t.state = 'Succeeded' AND o.metric = e.objective_metric AND {num_sql('o.value')} IS NOT NULL)
WHERE rn <= ms_start_step GROUP BY experiment, trial""", "obs", "trials_state", "experiments"))
def q_history_avg(spark, d):
    c = Ctx(spark, d)
    root = scratch(spark, "history")
    s = _obs_stream(spark, _obs_dir(spark, d), max_files=_batch_files(spark))
    streams.history_average(s, c.trials_state, c.experiments, f"{root}/table", f"{root}/ckpt")
    t = streams.history_table(spark, f"{root}/table")
    return t.select("experiment", "trial", F.round("avg", 9).alias("avg"))


@register("o94_rolling_gauges", with_views("""
SELECT namespace, coalesce(conditions[-1].type, 'Unknown') AS last_condition, count(*) AS trials
FROM trials GROUP BY ALL""", "trials"))
def q_rolling(spark, d):
    c = Ctx(spark, d)
    root = scratch(spark, "gauges")
    ch = c.trials.select("trial", "namespace", F.posexplode("conditions").alias("ord", "c")).select(
        "trial", "namespace", F.col("c.type").alias("state"), F.col("ord").cast("long").alias("ord"))
    ch.write.parquet(f"{root}/src")
    s = spark.readStream.schema("trial string, namespace string, state string, ord long").option(
        "maxFilesPerTrigger", 2).parquet(f"{root}/src")
    streams.rolling_gauges(s, f"{root}/sink", f"{root}/ckpt")
    return streams.gauges_now(spark, f"{root}/sink")
