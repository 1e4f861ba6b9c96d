"""Observation folding.

The metric log is folded into one (min, max, latest) observation per
(trial, metric) with declarative aggregates only: ``min_by``/``max_by`` are
partially aggregated map-side, so one trial holding a third of all rows
still spreads over every task before the final merge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trialfold.functions.exprs import UNAVAILABLE, num, rfc3339_parts, small, time_key


def default_strategies(experiments: DataFrame) -> DataFrame:
    """Per experiment the effective metric strategies, in order:
    explicit ones first, then the objective's default, then each additional
    metric's default (objective type min/max, else latest).
    Output: (experiment, pos, metric, strategy)."""
    t = F.col("objective_type")
    dflt = F.when(t == "minimize", F.lit("min")).when(t == "maximize", F.lit("max")).otherwise(F.lit("latest"))
    explicit = F.coalesce(F.col("metric_strategies"), F.array().cast("array<struct<name:string,value:string>>"))
    names = F.transform(explicit, lambda s: s["name"])
    # objective: default unless explicitly given; additional: unless explicitly
    # given for a non-objective name (the objective's explicit entry is not
    # counted for additional metrics, as in the reference)
    other_names = F.transform(F.filter(explicit, lambda s: s["name"] != F.col("objective_metric")), lambda s: s["name"])
    obj_default = F.when(~F.array_contains(names, F.col("objective_metric")),
                         F.array(F.struct(F.col("objective_metric").alias("name"), dflt.alias("value"))))
    add = F.filter(F.coalesce(F.col("additional_metrics"), F.array().cast("array<string>")),
                   lambda m: ~F.array_contains(other_names, m))
    add_default = F.transform(add, lambda m: F.struct(m.alias("name"), dflt.alias("value")))
    full = F.concat(explicit, F.coalesce(obj_default, F.array().cast("array<struct<name:string,value:string>>")), add_default)
    return experiments.select("experiment", F.posexplode(full).alias("pos", "s")).select(
        "experiment", F.col("pos").cast("int").alias("pos"), F.col("s.name").alias("metric"),
        F.col("s.value").alias("strategy"))


def trial_metric_list(trials: DataFrame, strategies: DataFrame) -> DataFrame:
    """(trial, experiment, metric, strategy) for every trial; the strategy
    table is per experiment and broadcast behind a size check."""
    return trials.select("trial", "experiment").join(small(strategies), "experiment")


def fold_observations(obs: DataFrame, trial_metrics: DataFrame) -> DataFrame:
    """Per (trial, metric in strategies): numeric min and max keeping
    the original text (first one wins on ties, in log order = time order
    then seq), latest by time (ties -> later row).  Unseen metric => three
    times 'unavailable'.  Output (trial, metric, min, max, latest)."""
    cols = obs.columns
    nanos = F.col("ts_nanos") if "ts_nanos" in cols else None
    sub = F.col("sub") if "sub" in cols else F.lit(0).cast("long")
    # aggregate first (partial aggregation map-side, so a hot trial is
    # reduced on every task), join the wanted (trial, metric) list after
    o = obs.select("trial", "metric", "value", num("value").alias("num"),
                   time_key(F.col("ts"), nanos).alias("tk"), F.col("seq").alias("seq"), sub.alias("sub"))
    agg = _aggregate(o)
    return (trial_metrics.select("trial", "metric").join(agg, ["trial", "metric"], "left")
            .select("trial", "metric",
                    F.coalesce("min", F.lit(UNAVAILABLE)).alias("min"),
                    F.coalesce("max", F.lit(UNAVAILABLE)).alias("max"),
                    F.coalesce("latest", F.lit(UNAVAILABLE)).alias("latest")))


def bad_times(rows: DataFrame) -> DataFrame:
    """O21's error side: log rows with a time that is no RFC3339 time.  The
    fold ranks them as untimed; this names them.  Rows without a time aren't
    at fault.  Output (trial, seq, metric, ts_raw)."""
    ts, _ = rfc3339_parts(F.col("ts_raw"))
    return rows.filter((F.col("ts_raw") != "") & ts.isNull()).select("trial", "seq", "metric", "ts_raw")


def _aggregate(o: DataFrame) -> DataFrame:
    isnum = F.col("num").isNotNull()
    return o.groupBy("trial", "metric").agg(
        F.min_by("value", F.when(isnum, F.struct("num", "tk", "seq", "sub"))).alias("min"),
        F.max_by("value", F.when(isnum, F.struct(F.col("num"), -F.col("tk"), -F.col("seq"), -F.col("sub")))).alias("max"),
        F.max_by("value", F.struct("tk", "seq", "sub")).alias("latest"),
    )


def fold_with_objective_fallback(rows: DataFrame, trial_metrics: DataFrame, objectives: DataFrame) -> DataFrame:
    """O19 + O21 in one pass over the parsed log: fold first, then a trial
    whose log holds no objective row gets every metric 'unavailable' —
    exactly what folding its replaced log (one 'unavailable' objective row)
    gives.  The log is read once; the objective test runs on the folded
    (trial, metric) keys.  ``objectives``: (trial, objective)."""
    nanos = F.col("ts_nanos") if "ts_nanos" in rows.columns else None
    sub = F.col("sub") if "sub" in rows.columns else F.lit(0).cast("long")
    o = rows.select("trial", "metric", "value", num("value").alias("num"),
                    time_key(F.col("ts"), nanos).alias("tk"), F.col("seq").alias("seq"), sub.alias("sub"))
    # a trial's list always has its objective, so whether the log has it shows in
    # the folded list, and the log itself is parsed and read once
    j = (trial_metrics.select("trial", "metric").join(_aggregate(o), ["trial", "metric"], "left")
         .join(objectives.select("trial", "objective"), "trial", "left"))
    logged = (F.col("metric") == F.col("objective")) & F.col("latest").isNotNull()
    j = j.withColumn("has_obj", F.max(F.coalesce(logged, F.lit(False))).over(Window.partitionBy("trial")))  # one trial's metrics

    def col(c):
        return F.when(F.col("has_obj"), F.coalesce(c, F.lit(UNAVAILABLE))).otherwise(F.lit(UNAVAILABLE))

    return j.select("trial", "metric", col(F.col("min")).alias("min"), col(F.col("max")).alias("max"),
                    col(F.col("latest")).alias("latest"))


def pick(strategy: Column, mn: Column, mx: Column, latest: Column) -> Column:
    """Min -> min unless unavailable, then latest; max likewise;
    latest -> latest.  Unknown strategy -> NULL (empty in the reference)."""
    return (F.when(strategy == "min", F.when(mn == UNAVAILABLE, latest).otherwise(mn))
             .when(strategy == "max", F.when(mx == UNAVAILABLE, latest).otherwise(mx))
             .when(strategy == "latest", latest))


def picked_values(observation: DataFrame, trial_metrics: DataFrame, listed: bool = False) -> DataFrame:
    """O22 over tables: (trial, metric, strategy, value), with the place in
    the metric list (``pos``) where ``trial_metrics`` has it and ``listed``."""
    place = ["pos"] if listed else []
    return observation.join(trial_metrics.select("trial", "metric", "strategy", *place), ["trial", "metric"]).select(
        "trial", "metric", "strategy", *place,
        pick(F.col("strategy"), F.col("min"), F.col("max"), F.col("latest")).alias("value"))


def observation_available(observation: DataFrame, trials: DataFrame, experiments: DataFrame) -> DataFrame:
    """Trial has its objective metric with latest != 'unavailable'."""
    obj = small(experiments.select("experiment", F.col("objective_metric").alias("metric")))
    t = trials.select("trial", "experiment").join(obj, "experiment")
    ok = (observation.filter(F.col("latest") != UNAVAILABLE).select("trial", "metric")
          .join(t, ["trial", "metric"], "left_semi").select("trial").withColumn("available", F.lit(True)))
    return (trials.select("trial").join(ok, "trial", "left")
            .select("trial", F.coalesce("available", F.lit(False)).alias("available")))


def target_split(picked: DataFrame, trials: DataFrame, experiments: DataFrame) -> DataFrame:
    """Objective value and the remaining metrics (name-sorted
    'name=value' text) per trial; trials without an objective dropped."""
    obj = small(experiments.select("experiment", F.col("objective_metric").alias("objective")))
    p = picked.join(trials.select("trial", "experiment"), "trial").join(obj, "experiment")
    is_obj = F.col("metric") == F.col("objective")
    g = p.groupBy("trial").agg(
        F.max(F.when(is_obj, F.col("value"))).alias("target_value"),
        F.max(F.when(is_obj, F.lit(1)).otherwise(F.lit(0))).alias("has_obj"),
        F.array_join(F.array_sort(F.collect_list(F.when(~is_obj, F.concat_ws("=", "metric", "value")))), ";").alias("additional"),
    )
    return g.filter(F.col("has_obj") == 1).drop("has_obj")


def last_listed_value(picked: DataFrame, trials: DataFrame, experiments: DataFrame) -> DataFrame:
    """The objective's value scanning the metric list (``pos``) from its
    end; it must parse as a float (else NULL + error flag)."""
    obj = small(experiments.select("experiment", F.col("objective_metric").alias("objective")))
    p = (picked.join(trials.select("trial", "experiment"), "trial").join(obj, "experiment")
         .filter(F.col("metric") == F.col("objective")))
    g = p.groupBy("trial").agg(F.max_by("value", "pos").alias("raw"))
    return g.select("trial", num("raw").alias("value"), num("raw").isNull().alias("parse_error"))


def completed_mean(picked: DataFrame, trials_state: DataFrame, experiments: DataFrame) -> DataFrame:
    """Mean objective over Succeeded trials and count of Failed ones,
    per experiment."""
    obj = small(experiments.select("experiment", F.col("objective_metric").alias("objective")))
    t = trials_state.select("trial", "experiment", "state").join(obj, "experiment")
    v = picked.join(t, "trial").filter(F.col("metric") == F.col("objective"))
    ok = v.filter(F.col("state") == "Succeeded")
    per_exp = ok.groupBy("experiment").agg(F.count("*").alias("n_completed"), F.avg(num("value")).alias("avg_objective"))
    failed = t.filter(F.col("state") == "Failed").groupBy("experiment").agg(F.count("*").alias("n_failed"))
    return (experiments.select("experiment").join(per_exp, "experiment", "left").join(failed, "experiment", "left")
            .select("experiment", F.coalesce("n_completed", F.lit(0)).alias("n_completed"),
                    F.coalesce("n_failed", F.lit(0)).alias("n_failed"), "avg_objective"))
