"""Registered queries: one per operator of the inventory.

``QUERIES[key] = fn(spark, sf_dir) -> DataFrame`` and, for the operators
that plain SQL can express, ``ORACLE[key]`` = DuckDB SQL over the same
parquet tables.  Outputs are flattened to scalar columns (timestamps as
text, arrays joined) so value hashes compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trialfold.functions.exprs import DEFAULT_FILTER, ts_text
from trialfold.operators import fold, parse, state
from trialfold.plans import views
from trialfold.plans.oracle import num_sql, tk_sql, with_views
from trialfold.plans.pipelines import Ctx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


# ---------------------------------------------------------------- lambda log: rows

_PAIR_RE = DEFAULT_FILTER
TEXT_ROWS = [
    ("parsed", r"""
  SELECT l.trial, l.line_no AS seq, m.pos - 1 AS sub,
    CASE WHEN ok THEN tok ELSE '0001-01-01T00:00:00Z' END AS ts_raw,
    CASE WHEN ok THEN strftime(strptime(substr(tok, 1, 26), '%Y-%m-%dT%H:%M:%S.%f'), '%Y-%m-%d %H:%M:%S.%f') END AS ts,
    trim(m.pair[1]) AS metric, trim(m.pair[2]) AS value, l.metrics
  FROM (SELECT *, CASE WHEN strpos(line, ' ') > 0 THEN split_part(line, ' ', 1) END AS tok,
          coalesce(regexp_matches(CASE WHEN strpos(line, ' ') > 0 THEN split_part(line, ' ', 1) END,
            '^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$'), false) AS ok
        FROM (SELECT ll.*, [e.objective_metric] || e.additional_metrics AS metrics
              FROM log_lines ll JOIN experiments e USING (experiment))
        WHERE len(list_filter(metrics, lambda m: contains(line, m))) > 0) l,
  LATERAL (SELECT generate_subscripts(ms, 1) AS pos, unnest(ms) AS pair
           FROM (SELECT list_transform(regexp_extract_all(l.line, 'PAIR', 0),
                    lambda s: [regexp_extract(s, 'PAIR', 1), regexp_extract(s, 'PAIR', 2)]) AS ms)) m
  WHERE list_contains(l.metrics, trim(m.pair[1]))""".replace("PAIR", _PAIR_RE)),
    ("tl", "SELECT t.trial, e.objective_metric AS objective FROM trials t JOIN experiments e USING (experiment)"),
    ("with_obj", "SELECT DISTINCT p.trial FROM parsed p JOIN tl USING (trial) WHERE p.metric = tl.objective"),
    ("text_obs", """
  SELECT trial, seq, sub, ts_raw, ts, metric, value FROM parsed WHERE trial IN (SELECT trial FROM with_obj)
  UNION ALL
  SELECT trial, 0, 0, '0001-01-01T00:00:00Z', NULL, objective, 'unavailable' FROM tl
  WHERE trial NOT IN (SELECT trial FROM with_obj)"""),
]


def _text_rows_sql(body: str, *more: str, extra=None) -> str:
    return with_views(body, "log_lines", "experiments", "trials", *more, extra=TEXT_ROWS + (extra or []))


@register("o12_o16_text_log_parse", _text_rows_sql(
    "SELECT trial, seq, sub, ts_raw, ts, metric, value FROM parsed"))
def q_text_parse(spark, d):
    c = Ctx(spark, d)
    lines = parse.attach_metric_lists(views.log_lines(spark, d), c.experiments)
    r = parse.parse_text_lines(lines)
    return r.select("trial", "seq", "sub", "ts_raw", ts_text(F.col("ts")).alias("ts"), "metric", "value")


@register("o19_objective_fallback", _text_rows_sql(
    "SELECT trial, seq, sub, ts_raw, ts, metric, value FROM text_obs"))
def q_fallback(spark, d):
    c = Ctx(spark, d)
    return c.text_obs.select("trial", "seq", "sub", "ts_raw", ts_text(F.col("ts")).alias("ts"), "metric", "value")


# ------------------------------------------------------------------ folding

#: Texts in the place of the values of every 13 log rows (None: as they are).
NUMBER_TEXTS = [None, "inf", "-Infinity", "1e400", "0x1.8p3", "NaN", "12d", " 1", "+.5", None, None, None, None]

@register("o23_default_strategies", with_views("SELECT * FROM strategies", "strategies"))
def q_strategies(spark, d):
    return Ctx(spark, d).strategies


@register("o21_minmaxlatest_fold", with_views("SELECT * FROM observation", "observation"))
def q_fold(spark, d):
    return Ctx(spark, d).observation


@register("o21b_text_log_fold", _text_rows_sql(f"""
SELECT tm.trial, tm.metric, coalesce(a.min, 'unavailable') AS min, coalesce(a.max, 'unavailable') AS max,
       coalesce(a.latest, 'unavailable') AS latest
FROM trial_metrics tm LEFT JOIN (
  SELECT trial, metric,
    arg_min(value, row(num, tk, seq, sub)) FILTER (WHERE num IS NOT NULL) AS min,
    arg_max(value, row(num, -tk, -seq, -sub)) FILTER (WHERE num IS NOT NULL) AS max,
    arg_max(value, row(tk, seq, sub)) AS latest
  FROM (SELECT trial, metric, value, {num_sql('value')} AS num,
          {tk_sql('CAST(ts AS TIMESTAMP)')} AS tk, seq, sub FROM text_obs)
  GROUP BY trial, metric) a USING (trial, metric)""", "trial_metrics"))
def q_text_fold(spark, d):
    return Ctx(spark, d).text_observation


@register("o21c_number_texts", with_views("""
SELECT tm.trial, tm.metric, coalesce(a.min, 'unavailable') AS min, coalesce(a.max, 'unavailable') AS max,
       coalesce(a.latest, 'unavailable') AS latest
FROM trial_metrics tm LEFT JOIN (
  SELECT trial, metric,
    arg_min(value, row(num, tk, seq)) FILTER (WHERE num IS NOT NULL) AS min,
    arg_max(value, row(num, -tk, -seq)) FILTER (WHERE num IS NOT NULL) AS max,
    arg_max(value, row(tk, seq)) AS latest
  FROM (SELECT 'trial-' || user_id AS trial, event_type AS metric, event_id AS seq, epoch_us(ts) * 1000 AS tk,
          CASE event_id % 13 WHEN 1 THEN 'inf' WHEN 2 THEN '-Infinity' WHEN 3 THEN '1e400' WHEN 4 THEN '0x1.8p3'
               WHEN 5 THEN 'NaN' WHEN 6 THEN '12d' WHEN 7 THEN ' 1' WHEN 8 THEN '+.5' ELSE CAST(value AS VARCHAR) END AS value,
          CASE event_id % 13 WHEN 1 THEN 'infinity'::DOUBLE WHEN 2 THEN '-infinity'::DOUBLE WHEN 3 THEN NULL WHEN 4 THEN 12.0
               WHEN 5 THEN NULL WHEN 6 THEN NULL WHEN 7 THEN NULL WHEN 8 THEN 0.5 ELSE value END AS num
        FROM events)
  GROUP BY trial, metric) a USING (trial, metric)""", "trial_metrics"))
def q_number_texts(spark, d):
    c = Ctx(spark, d)
    text, kind = F.col("value"), F.col("seq") % len(NUMBER_TEXTS)
    for i, t in enumerate(NUMBER_TEXTS):
        text = F.when(kind == i, F.lit(t)).otherwise(text) if t else text
    return fold.fold_observations(c.obs.withColumn("value", text), c.trial_metrics)


@register("o21d_bad_times", """
SELECT 'trial-' || user_id AS trial, event_id AS seq, event_type AS metric,
  CASE WHEN event_id % 50 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') ELSE '2024-02-30T00:00:00Z' END AS ts_raw
FROM events WHERE event_id % 50 = 0 OR event_id % 50 = 7""")
def q_bad_times(spark, d):
    kind = F.col("seq") % 50
    raw = (F.when(kind == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).when(kind == 7, F.lit("2024-02-30T00:00:00Z"))
           .when(kind == 9, F.lit("")).when(kind == 11, F.lit(None).cast("string"))
           .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")))
    return fold.bad_times(Ctx(spark, d).obs.withColumn("ts_raw", raw))


@register("o22_strategy_pick", with_views("SELECT * FROM picked", "picked"))
def q_pick(spark, d):
    return Ctx(spark, d).picked


@register("o24_observation_available", with_views("SELECT * FROM available", "available"))
def q_available(spark, d):
    return Ctx(spark, d).available


@register("o25_target_split", with_views("""
SELECT p.trial, max(CASE WHEN p.metric = e.objective_metric THEN p.value END) AS target_value,
  array_to_string(list_sort(list(p.metric || '=' || p.value) FILTER (WHERE p.metric <> e.objective_metric)), ';') AS additional
FROM picked p JOIN trials t USING (trial) JOIN experiments e USING (experiment)
GROUP BY p.trial HAVING max(CASE WHEN p.metric = e.objective_metric THEN 1 ELSE 0 END) = 1""",
                                         "picked", "trials", "experiments"))
def q_target_split(spark, d):
    c = Ctx(spark, d)
    r = fold.target_split(c.picked, c.trials, c.experiments)
    return r.select("trial", "target_value", F.when(F.col("additional") == "", F.lit(None)).otherwise(F.col("additional")).alias("additional"))


@register("o26_last_listed_value", with_views(f"""
SELECT p.trial, {num_sql('p.value')} AS value, {num_sql('p.value')} IS NULL AS parse_error
FROM picked p JOIN trials t USING (trial) JOIN experiments e USING (experiment)
WHERE p.metric = e.objective_metric""", "picked", "trials", "experiments"))
def q_last_listed(spark, d):
    c = Ctx(spark, d)
    return fold.last_listed_value(fold.picked_values(c.observation, c.trial_metrics, listed=True), c.trials, c.experiments)


@register("o27_completed_mean", with_views(f"""
SELECT e.experiment, coalesce(a.n_completed, 0)::BIGINT AS n_completed, coalesce(f.n_failed, 0)::BIGINT AS n_failed,
  round(a.avg_objective, 9) AS avg_objective
FROM experiments e
LEFT JOIN (SELECT t.experiment, count(*) AS n_completed, avg({num_sql('p.value')}) AS avg_objective
           FROM picked p JOIN trials_state t USING (trial) JOIN experiments e2 ON e2.experiment = t.experiment
           WHERE p.metric = e2.objective_metric AND t.state = 'Succeeded' GROUP BY t.experiment) a USING (experiment)
LEFT JOIN (SELECT experiment, count(*) AS n_failed FROM trials_state WHERE state = 'Failed' GROUP BY experiment) f
  USING (experiment)""", "experiments", "picked", "trials_state"))
def q_completed_mean(spark, d):
    c = Ctx(spark, d)
    r = fold.completed_mean(c.picked, c.trials_state, c.experiments)
    return r.withColumn("avg_objective", F.round("avg_objective", 9))


# -------------------------------------------------------------------- state

@register("o28_trial_state", with_views("SELECT trial, experiment, declared_state, state FROM trials_state", "trials_state"))
def q_trial_state(spark, d):
    return Ctx(spark, d).trials_state.select("trial", "experiment", "declared_state", "state")


@register("o29_last_condition", with_views("""
SELECT trial, coalesce(conditions[-1].type, 'Unknown') AS last_condition FROM trials""", "trials"))
def q_last_condition(spark, d):
    return Ctx(spark, d).trials.select("trial", state.last_condition(F.col("conditions")).alias("last_condition"))


@register("o30_experiment_summary", with_views("SELECT * FROM summary", "summary"))
def q_summary(spark, d):
    return Ctx(spark, d).summary


@register("o30b_state_lists", with_views("SELECT experiment, state, pos, trial FROM trials_state", "trials_state"))
def q_state_lists(spark, d):
    return state.state_lists(Ctx(spark, d).trials_state)


@register("o31_o32_optimal_trial", with_views("SELECT * FROM best", "best"))
def q_best(spark, d):
    return Ctx(spark, d).best()


@register("o33_experiment_verdict", with_views("SELECT * FROM verdict", "verdict"))
def q_verdict(spark, d):
    return Ctx(spark, d).verdict()


@register("o34_slot_budget", with_views("SELECT * FROM budget", "budget"))
def q_budget(spark, d):
    return Ctx(spark, d).budget


@register("o35_excess_trials", with_views("""
SELECT experiment, trial, rank FROM (
  SELECT t.experiment, t.trial, b.delete_count,
    row_number() OVER (PARTITION BY t.experiment ORDER BY t.created DESC, t.pos DESC) AS rank
  FROM trials_state t JOIN budget b USING (experiment) WHERE b.delete_count > 0)
WHERE rank <= delete_count""", "trials_state", "budget"))
def q_excess(spark, d):
    c = Ctx(spark, d)
    return state.excess_trials(c.trials_state, c.budget).withColumn("rank", F.col("rank").cast("long"))


@register("o36_new_assignments", with_views("""
SELECT a.experiment, a.trial FROM assignments a
WHERE NOT EXISTS (SELECT 1 FROM trials_state t WHERE t.experiment = a.experiment AND t.trial = a.trial
                  AND t.state <> 'Pending')""", "assignments", "trials_state"))
def q_new_assignments(spark, d):
    c = Ctx(spark, d)
    created = c.trials_state.filter(F.col("state") != "Pending")
    return state.new_assignments(views.assignments(spark, d).select("experiment", "trial"), created)


@register("o36b_remaining_suggestions", with_views("""
SELECT a.experiment, a.trial FROM assignments a LEFT JOIN (
  SELECT t.experiment, t.trial, b.delete_count,
    row_number() OVER (PARTITION BY t.experiment ORDER BY t.created DESC, t.pos DESC) AS rank
  FROM trials_state t JOIN budget b USING (experiment)) x ON x.experiment = a.experiment AND x.trial = a.trial
WHERE NOT coalesce(x.rank <= x.delete_count, false)""", "assignments", "trials_state", "budget"))
def q_remaining(spark, d):
    c = Ctx(spark, d)
    return state.remaining_suggestions(views.assignments(spark, d).select("experiment", "trial"),
                                       state.excess_trials(c.trials_state, c.budget))


@register("o37_request_count", with_views("""
SELECT s.experiment, s.trials + b.add_count - coalesce(es.n, 0) AS requests
FROM summary s JOIN budget b USING (experiment)
LEFT JOIN (SELECT t.experiment, count(*) AS n FROM trials_state t JOIN available a USING (trial)
           WHERE t.state = 'EarlyStopped' AND NOT a.available GROUP BY t.experiment) es USING (experiment)""",
                                          "summary", "budget", "trials_state", "available"))
def q_request_count(spark, d):
    c = Ctx(spark, d)
    return state.request_count(c.summary, c.budget, c.trials_state, c.available)


@register("o38_restartable", with_views("""
SELECT v.experiment, v.status = 'Succeeded' AND v.reason = 'ExperimentMaxTrialsReached'
  AND e.resume_policy IN ('LongRunning', 'FromVolume') AS restartable
FROM verdict v JOIN experiments e USING (experiment)""", "verdict", "experiments"))
def q_restartable(spark, d):
    c = Ctx(spark, d)
    return state.restartable(c.verdict(), c.experiments)


@register("o39_algorithm_input", with_views("""
SELECT t2.experiment, t2.trial, t2.condition, p.metric, p.value FROM t2 JOIN picked p USING (trial)
WHERE t2.trial IN (SELECT p2.trial FROM picked p2 JOIN t2 x USING (trial) JOIN experiments e USING (experiment)
                   WHERE p2.metric = e.objective_metric)""", "trials_state", "available", "picked", "experiments", extra=[
    ("t1", """SELECT s.experiment, s.trial, CASE coalesce(s.conditions[-1].type, 'Unknown')
        WHEN 'Created' THEN 'CREATED' WHEN 'Running' THEN 'RUNNING' WHEN 'Succeeded' THEN 'SUCCEEDED'
        WHEN 'Killed' THEN 'KILLED' WHEN 'Failed' THEN 'FAILED' WHEN 'EarlyStopped' THEN 'EARLYSTOPPED'
        ELSE 'UNKNOWN' END AS condition
      FROM trials_state s JOIN available a USING (trial)
      WHERE NOT coalesce(list_filter(s.conditions, lambda c: c.type = 'MetricsUnavailable')[1].status = 'True', false)
        AND NOT (coalesce(list_filter(s.conditions, lambda c: c.type = 'EarlyStopped')[1].status = 'True', false)
                 AND NOT a.available)"""),
    ("t2", "SELECT * FROM t1 WHERE condition IN ('SUCCEEDED', 'EARLYSTOPPED')")]))
def q_algorithm_input(spark, d):
    c = Ctx(spark, d)
    return state.algorithm_input(c.trials_state, c.available, c.picked, c.experiments)



def _hc(t: str) -> str:
    return f"coalesce(list_filter(t.conditions, lambda c: c.type = '{t}')[1].status = 'True', false)"


@register("o39b_job_outcome", with_views(f"""
SELECT trial, job_condition, CASE
    WHEN job_condition = 'Succeeded' THEN CASE
      WHEN available AND NOT {_hc('Succeeded')} THEN CASE WHEN NOT {_hc('EarlyStopped')} THEN 'Succeeded' END
      WHEN NOT {_hc('MetricsUnavailable')} THEN 'MetricsUnavailable' END
    WHEN job_condition = 'Failed' AND NOT {_hc('Failed')} AND NOT {_hc('EarlyStopped')} THEN 'Failed'
    WHEN job_condition = 'Running' AND NOT {_hc('Running')} AND NOT {_hc('EarlyStopped')} THEN 'Running'
  END AS new_state
FROM (SELECT t.trial, t.conditions, a.available, CASE
        WHEN len(list_filter(j.job_conditions, lambda c: c.type = 'Failed' AND c.status = 'True')) > 0 THEN 'Failed'
        WHEN len(list_filter(j.job_conditions, lambda c: (c.type = 'Complete' OR c.type = 'Succeeded') AND c.status = 'True')) > 0
          THEN 'Succeeded'
        WHEN NOT {_hc('Running')} AND coalesce(j.job_name, '') <> '' THEN 'Running' END AS job_condition
      FROM trials_state t JOIN jobs j USING (trial) JOIN available a USING (trial)) t""", "trials_state", "jobs", "available"))
def q_job_outcome(spark, d):
    c = Ctx(spark, d)
    return state.job_outcome(c.trials_state, views.jobs(spark, d), c.available)


# more registered queries live in sibling modules
from trialfold.plans import q_sources  # noqa: E402,F401
from trialfold.plans import q_space  # noqa: E402,F401
from trialfold.plans import q_guide  # noqa: E402,F401
from trialfold.plans import q_report  # noqa: E402,F401
from trialfold.plans import q_pipeline  # noqa: E402,F401
from trialfold.plans import q_models  # noqa: E402,F401
from trialfold.plans import q_stream  # noqa: E402,F401
from trialfold.plans import q_validate  # noqa: E402,F401
