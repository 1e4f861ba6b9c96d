"""Trial and experiment state.

All operators run over every experiment in one plan: per-trial predicates
are column expressions, per-experiment summaries are partially aggregated
``groupBy`` aggregates (skew-safe), the best trial is a ``max_by`` over an
ordering struct, and per-experiment top-k uses a salted two-phase window so
one huge experiment is never ranked inside a single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trialfold.functions.exprs import UNAVAILABLE, num, small
from trialfold.functions.select import smallest
from trialfold.operators.fold import pick

# Trial condition types and experiment condition reasons.
STATE_PRECEDENCE = ["Killed", "Failed", "Succeeded", "EarlyStopped", "Running", "MetricsUnavailable"]
REASON_GOAL = "ExperimentGoalReached"
REASON_FAILED = "ExperimentFailed"
REASON_MAX_TRIALS = "ExperimentMaxTrialsReached"
REASON_SUGGESTION_END = "ExperimentSuggestionEndReached"
REASON_RUNNING = "ExperimentRunning"
API_CONDITION = {"Created": "CREATED", "Running": "RUNNING", "Succeeded": "SUCCEEDED", "Killed": "KILLED",
                 "Failed": "FAILED", "EarlyStopped": "EARLYSTOPPED"}
STATES = ["Killed", "Failed", "Succeeded", "EarlyStopped", "Running", "MetricsUnavailable", "Pending"]


def has_condition(conditions: Column, ctype: str) -> Column:
    """First condition of the type exists and is 'True'."""
    first = F.try_element_at(F.filter(conditions, lambda c: c["type"] == ctype), F.lit(1))
    return F.coalesce(first["status"] == "True", F.lit(False))


def state_of(conditions: Column) -> Column:
    """Killed > Failed > Succeeded > EarlyStopped > Running >
    MetricsUnavailable > Pending."""
    out = F.lit("Pending")
    for s in reversed(STATE_PRECEDENCE):
        out = F.when(has_condition(conditions, s), F.lit(s)).otherwise(out)
    return out


def classify_trials(trials: DataFrame) -> DataFrame:
    """Add ``state``."""
    return trials.withColumn("state", state_of(F.col("conditions")))


def last_condition(conditions: Column) -> Column:
    """Type of the last condition, 'Unknown' when there is none."""
    return F.coalesce(F.try_element_at(conditions, F.lit(-1))["type"], F.lit("Unknown"))


def experiment_summary(trials_state: DataFrame, experiments: DataFrame) -> DataFrame:
    """Per experiment total and per-state counts (every experiment,
    also those without trials).  The per-state name lists are the long
    table ``state_lists``; they are never packed into one row."""
    aggs = [F.count("*").alias("trials")]
    for s in STATES:
        aggs.append(F.count_if(F.col("state") == s).alias(f"trials_{_snake(s)}"))
    g = trials_state.groupBy("experiment").agg(*aggs)
    cols = ["trials"] + [f"trials_{_snake(s)}" for s in STATES]
    return (experiments.select("experiment").join(g, "experiment", "left")
            .select("experiment", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in cols]))


def state_lists(trials_state: DataFrame) -> DataFrame:
    """O30 name lists in long form: (experiment, state, pos, trial)."""
    return trials_state.select("experiment", "state", "pos", "trial")


def _snake(s: str) -> str:
    return "".join("_" + c.lower() if c.isupper() else c for c in s).lstrip("_")


def objective_values(observation: DataFrame, trials_state: DataFrame, strategies: DataFrame,
                     experiments: DataFrame) -> DataFrame:
    """Objective value of every trial picked by its strategy (O22):
    (experiment, trial, pos, state, value)."""
    obj = small(experiments.select("experiment", F.col("objective_metric").alias("metric")).join(
        strategies.select("experiment", "metric", "strategy"), ["experiment", "metric"], "left"))
    t = trials_state.select("experiment", "trial", "pos", "state").join(obj, "experiment")
    o = t.join(observation, ["trial", "metric"], "left")
    v = F.coalesce(pick(F.col("strategy"), F.col("min"), F.col("max"), F.col("latest")), F.lit(UNAVAILABLE))
    return o.select("experiment", "trial", "pos", "state", v.alias("value"))


def optimal_trial(objective: DataFrame, experiments: DataFrame) -> DataFrame:
    """Best trial per experiment: first strictly better numeric
    value in list order (minimize '<', maximize '>'); a text value wins
    only when no numeric value exists (last such trial, Q3).  Goal reached
    when the best numeric value passes the goal.
    Output (experiment, best_trial, best_value, goal_reached)."""
    e = small(experiments.select("experiment", "objective_type", "goal"))
    o = objective.filter(F.col("value") != UNAVAILABLE).join(e, "experiment")
    x = num("value")
    sign = F.when(F.col("objective_type") == "minimize", F.lit(-1.0)).when(
        F.col("objective_type") == "maximize", F.lit(1.0)).otherwise(F.lit(0.0))
    o = o.withColumn("x", x).withColumn("sx", sign * F.col("x"))
    g = o.groupBy("experiment").agg(
        F.max_by(F.struct("trial", "value"), F.when(F.col("x").isNotNull(), F.struct("sx", -F.col("pos")))).alias("bn"),
        F.max_by(F.struct("trial", "value"), F.when(F.col("x").isNull(), F.col("pos"))).alias("bt"),
        F.min(F.when(F.col("objective_type") == "minimize", F.col("x"))).alias("min_x"),
        F.max(F.when(F.col("objective_type") == "maximize", F.col("x"))).alias("max_x"),
    )
    best = F.coalesce(F.col("bn"), F.col("bt"))
    reached = (F.when(F.col("goal").isNull(), F.lit(False))
               .when(F.col("objective_type") == "minimize", F.coalesce(F.col("min_x") <= F.col("goal"), F.lit(False)))
               .when(F.col("objective_type") == "maximize", F.coalesce(F.col("max_x") >= F.col("goal"), F.lit(False)))
               .otherwise(F.lit(False)))
    return (experiments.select("experiment", "objective_type", "goal").join(g, "experiment", "left")
            .select("experiment", best["trial"].alias("best_trial"), best["value"].alias("best_value"),
                    reached.alias("goal_reached")))


def verdict(summary: DataFrame, best: DataFrame, experiments: DataFrame) -> DataFrame:
    """Experiment condition ladder.  Output adds (status, reason,
    completed, failed_total, active)."""
    s = summary.join(best.select("experiment", "goal_reached", "best_trial", "best_value"), "experiment", "left").join(
        experiments.select("experiment", "max_trial_count", "max_failed_trial_count", "suggestions_ended"), "experiment")
    completed = (F.col("trials_succeeded") + F.col("trials_failed") + F.col("trials_killed")
                 + F.col("trials_early_stopped") + F.col("trials_metrics_unavailable"))
    failed = F.col("trials_failed") + F.col("trials_metrics_unavailable")
    active = F.col("trials_pending") + F.col("trials_running")
    mf, mt = F.col("max_failed_trial_count"), F.col("max_trial_count")
    reason = (F.when(F.coalesce(F.col("goal_reached"), F.lit(False)), F.lit(REASON_GOAL))
              .when(mf.isNotNull() & (failed != 0) & (failed >= mf), F.lit(REASON_FAILED))
              .when(mt.isNotNull() & (completed >= mt), F.lit(REASON_MAX_TRIALS))
              .when(F.coalesce(F.col("suggestions_ended"), F.lit(False)) & (active == 0), F.lit(REASON_SUGGESTION_END))
              .otherwise(F.lit(REASON_RUNNING)))
    status = (F.when(reason == REASON_FAILED, F.lit("Failed"))
              .when(reason == REASON_RUNNING, F.lit("Running")).otherwise(F.lit("Succeeded")))
    return s.select(*summary.columns, "best_trial", "best_value",
                    F.coalesce("goal_reached", F.lit(False)).alias("goal_reached"),
                    completed.alias("completed"), failed.alias("failed_total"), active.alias("active"),
                    status.alias("status"), reason.alias("reason"))


def slot_budget(summary: DataFrame, experiments: DataFrame) -> DataFrame:
    """Trials to delete / add; completed here leaves out
    MetricsUnavailable (Q5)."""
    s = summary.join(experiments.select("experiment", "parallel_trial_count", "max_trial_count"), "experiment")
    active = F.col("trials_pending") + F.col("trials_running")
    completed = F.col("trials_succeeded") + F.col("trials_failed") + F.col("trials_killed") + F.col("trials_early_stopped")
    par, mt = F.col("parallel_trial_count"), F.col("max_trial_count")
    required = F.when(mt.isNull(), par).otherwise(F.least(mt - completed, par))
    delete = F.when(active > par, active - par).otherwise(F.lit(0))
    add = F.when(active < par, F.greatest(required - active, F.lit(0))).otherwise(F.lit(0))
    return s.select("experiment", active.alias("active"), completed.alias("completed_budget"),
                    delete.cast("long").alias("delete_count"), add.cast("long").alias("add_count"))


def top_k_per_group(df: DataFrame, group: list[str], order: list[Column], k: Column, salts: int | None = None,
                    salt_key: Column | None = None) -> DataFrame:
    """Exact per-group top-k in two phases: top-k inside (group, salt)
    buckets, then top-k of the survivors.  A group with a third of all rows
    is ranked by ``salts`` tasks first (as many as shuffle partitions, unless
    given); the final window sees at most ``salts * k`` rows per group.  For
    bounded ``k``; ``functions.select.smallest`` takes any."""
    salts = salts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt = F.pmod(F.xxhash64(*(salt_key if salt_key is not None else [F.col(c) for c in df.columns])), F.lit(salts))
    # an explicit shuffle on all keys: a child already hashed on ``group``
    # alone would otherwise satisfy the window and defeat the salt
    d = df.withColumn("_k", k).withColumn("_salt", salt).repartition(*[F.col(c) for c in group], F.col("_salt"))
    w1 = Window.partitionBy(*group, "_salt").orderBy(*order)
    d = d.withColumn("_r", F.row_number().over(w1)).filter(F.col("_r") <= F.col("_k"))
    w2 = Window.partitionBy(*group).orderBy(*order)
    d = d.withColumn("rank", F.row_number().over(w2)).filter(F.col("rank") <= F.col("_k"))
    return d.drop("_k", "_salt", "_r")


def excess_trials(trials: DataFrame, budget: DataFrame, only_active: bool = False) -> DataFrame:
    """Newest-first trials to delete, k = delete_count (all if fewer).
    Chosen among all trials as in the reference (Q16) unless
    ``only_active``."""
    t = trials
    if only_active:
        t = t.filter(F.col("state").isin("Pending", "Running"))
    b = budget.filter(F.col("delete_count") > 0).select("experiment", "delete_count")
    t = t.join(b, "experiment")
    # k grows with the group, so its edge is selected without a window over the group
    return smallest(t, ["experiment"], -F.unix_micros(F.col("created").cast("timestamp")), -F.col("pos").cast("long"),
                    F.col("delete_count")).select("experiment", "trial", "rank")


def new_assignments(suggestions: DataFrame, trials: DataFrame) -> DataFrame:
    """Suggestions whose name is not yet a trial."""
    return suggestions.join(trials.select("experiment", "trial"), ["experiment", "trial"], "left_anti")


def remaining_suggestions(suggestions: DataFrame, deleted: DataFrame) -> DataFrame:
    """Suggestions without those whose trial was deleted."""
    return suggestions.join(deleted.select("experiment", "trial"), ["experiment", "trial"], "left_anti")


def request_count(summary: DataFrame, budget: DataFrame, trials_state: DataFrame, available: DataFrame) -> DataFrame:
    """Trials + add - early-stopped trials without observation."""
    es = (trials_state.filter(F.col("state") == "EarlyStopped").join(available, "trial")
          .filter(~F.col("available")).groupBy("experiment").agg(F.count("*").alias("incomplete_es")))
    s = summary.select("experiment", "trials").join(budget.select("experiment", "add_count"), "experiment").join(
        es, "experiment", "left")
    return s.select("experiment", (F.col("trials") + F.col("add_count")
                                   - F.coalesce("incomplete_es", F.lit(0))).alias("requests"))


def restartable(verdicts: DataFrame, experiments: DataFrame) -> DataFrame:
    """Succeeded by max trials and resume policy LongRunning/FromVolume."""
    v = verdicts.select("experiment", "status", "reason").join(experiments.select("experiment", "resume_policy"), "experiment")
    ok = ((F.col("status") == "Succeeded") & (F.col("reason") == REASON_MAX_TRIALS)
          & F.col("resume_policy").isin("LongRunning", "FromVolume"))
    return v.select("experiment", ok.alias("restartable"))


def api_condition(ctype: Column) -> Column:
    out = F.lit("UNKNOWN")
    for k, v in API_CONDITION.items():
        out = F.when(ctype == k, F.lit(v)).otherwise(out)
    return out


def algorithm_input(trials_state: DataFrame, available: DataFrame, picked: DataFrame, experiments: DataFrame) -> DataFrame:
    """Trials handed to a search algorithm: no MetricsUnavailable, no
    early-stopped without observation; last condition mapped to the API
    enum; then only SUCCEEDED/EARLYSTOPPED with an objective value.
    Output: (experiment, trial, condition, metric, value)."""
    t = (trials_state.join(available, "trial")
         .filter(~has_condition(F.col("conditions"), "MetricsUnavailable"))
         .filter(~(has_condition(F.col("conditions"), "EarlyStopped") & ~F.col("available")))
         .select("experiment", "trial", api_condition(last_condition(F.col("conditions"))).alias("condition")))
    t = t.filter(F.col("condition").isin("SUCCEEDED", "EARLYSTOPPED"))
    obj = small(experiments.select("experiment", F.col("objective_metric").alias("objective")))
    p = picked.select("trial", "metric", "value")
    with_obj = (p.join(t.join(obj, "experiment"), "trial").filter(F.col("metric") == F.col("objective"))
                .select("trial").distinct())
    return t.join(with_obj, "trial", "left_semi").join(p, "trial").select("experiment", "trial", "condition", "metric", "value")


def job_outcome(trials_state: DataFrame, jobs: DataFrame, available: DataFrame) -> DataFrame:
    """Resolve a deployed job's conditions into a trial state change.
    Failure condition first, then success, else Running when the trial is
    not running and the job has a name; then the transition rules.
    ``jobs``: (trial, job_name, job_conditions array<struct<type,status>>).
    Output: (trial, job_condition, new_state) with new_state NULL = no change."""
    jc = F.col("job_conditions")

    def job_has(t):
        return F.exists(jc, lambda c: (c["type"] == t) & (c["status"] == "True"))

    t = trials_state.select("trial", "conditions").join(jobs, "trial").join(available, "trial")
    conds = F.col("conditions")
    running = has_condition(conds, "Running")
    job = (F.when(job_has("Failed"), F.lit("Failed"))
           .when(job_has("Complete") | job_has("Succeeded"), F.lit("Succeeded"))
           .when(~running & (F.coalesce(F.col("job_name"), F.lit("")) != ""), F.lit("Running")))
    succ, es = has_condition(conds, "Succeeded"), has_condition(conds, "EarlyStopped")
    mu, failed = has_condition(conds, "MetricsUnavailable"), has_condition(conds, "Failed")
    avail = F.col("available")
    new = (F.when(job == "Succeeded",
                  F.when(avail & ~succ, F.when(~es, F.lit("Succeeded")))
                  .when(~(avail & ~succ) & ~mu, F.lit("MetricsUnavailable")))
           .when((job == "Failed") & ~failed & ~es, F.lit("Failed"))
           .when((job == "Running") & ~running & ~es, F.lit("Running")))
    return t.select("trial", job.alias("job_condition"), new.alias("new_state"))
