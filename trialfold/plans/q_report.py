"""Registered queries: reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from trialfold.operators import report, space
from trialfold.plans import views
from trialfold.plans.catalog import register
from trialfold.plans.oracle import num_sql, tk_sql, with_views
from trialfold.plans.pipelines import Ctx
from trialfold.plans.q_sources import scratch
from trialfold.sources import files

METRICS = ["purchase", "view", "click", "error"]
PARAMS = ["lr", "ne", "booster", "depth"]

REASON_MSG_SQL = "CASE reason " + " ".join(f"WHEN '{r}' THEN '{m}'" for r, m in report.REASON_MESSAGE) + " END"

COND_SQL = ("econd", f"""SELECT experiment, status, reason, list_filter([
      {{'type': 'Created', 'status': 'True', 'message': 'Experiment is created'}},
      {{'type': 'Running', 'status': CASE WHEN status = 'Running' THEN 'True' ELSE 'False' END, 'message': 'Experiment is running'}},
      CASE WHEN status <> 'Running' THEN {{'type': status, 'status': 'True', 'message': {REASON_MSG_SQL}}} END],
      lambda c: c IS NOT NULL) AS conditions FROM verdict""")


def _conditions(c: Ctx):
    return report.experiment_conditions(c.verdict())


@register("o57_experiment_listing", with_views("""
SELECT e.experiment, e.namespace, CASE WHEN e.algorithm IN ('enas', 'darts') THEN 'nas' ELSE 'hp' END AS type,
  coalesce(c.conditions[-1].type, 'Unknown') AS last_condition
FROM experiments e JOIN econd c USING (experiment) WHERE e.namespace IN ('ns-0', 'ns-2')""", "experiments", "verdict",
                                               extra=[COND_SQL]))
def q_listing(spark, d):
    c = Ctx(spark, d)
    return report.experiment_listing(c.experiments, _conditions(c), ["ns-0", "ns-2"])


BEST_SQL = ("bm", f"""SELECT trial, metric,
    coalesce(arg_min(value, {{'k': sgn * x, 'tk': tk, 'seq': seq}}) FILTER (WHERE x IS NOT NULL AND sgn IS NOT NULL),
             arg_min(value, {{'tk': tk, 'seq': seq}})) AS value
  FROM (SELECT ob.trial, ob.metric, ob.value, ob.seq, {num_sql('ob.value')} AS x, {tk_sql('ob.ts')} AS tk,
          CASE e.objective_type WHEN 'minimize' THEN 1.0 WHEN 'maximize' THEN -1.0 END AS sgn
        FROM obs ob JOIN trials_state t USING (trial) JOIN experiments e ON e.experiment = t.experiment
        WHERE t.state IN ('Succeeded', 'EarlyStopped') AND list_contains([e.objective_metric] || e.additional_metrics, ob.metric))
  GROUP BY trial, metric""")

TABLE_SQL = ("trial_table", """SELECT t.experiment, coalesce(t.conditions[-1].type, 'Unknown') AS last_condition, t.trial,
    """ + ",\n    ".join(f"max(bm.value) FILTER (WHERE bm.metric = '{m}') AS \"{m}\"" for m in METRICS) + """,
    """ + ",\n    ".join(f"list_filter(any_value(a.assignments), lambda x: x.name = '{p}')[1].value AS {p}" for p in PARAMS) + """,
    any_value(an.kfp_run) AS kfp_run
  FROM trials_state t LEFT JOIN bm USING (trial) LEFT JOIN assignments a ON a.trial = t.trial
  LEFT JOIN annotations an ON an.trial = t.trial
  GROUP BY t.experiment, t.trial, t.conditions""")


def _table(spark, d):
    c = Ctx(spark, d)
    best = report.best_metric_values(c.obs, c.trials_state, c.experiments)
    return report.trial_table(c.trials_state, best, views.assignments(spark, d), METRICS, PARAMS, views.annotations(spark, d))


_TABLE_VIEWS = ("obs", "trials_state", "experiments", "assignments", "annotations")


@register("o58_o59_trial_table", with_views("SELECT * FROM trial_table", *_TABLE_VIEWS, extra=[BEST_SQL, TABLE_SQL]))
def q_trial_table(spark, d):
    return _table(spark, d)


@register("o10_trial_table_export", with_views("SELECT * FROM trial_table", *_TABLE_VIEWS, extra=[BEST_SQL, TABLE_SQL]))
def q_export(spark, d):
    p = scratch(spark, "trial_table")
    files.export_table(_table(spark, d), p)
    return spark.read.option("header", True).csv(p)


CURVE_SQL = ("curve", f"""SELECT trial, metric, sec AS second,
    arg_min(value, {{'k': coalesce(sgn * x, 0.0), 'tk': tk, 'seq': seq}}) AS value
  FROM (SELECT ob.trial, ob.metric, ob.value, ob.seq, {num_sql('ob.value')} AS x, {tk_sql('ob.ts')} AS tk,
          coalesce(strftime(date_trunc('second', ob.ts), '%Y-%m-%dT%H:%M:%S'), '0001-01-01T00:00:00') AS sec,
          CASE e.objective_type WHEN 'minimize' THEN 1.0 WHEN 'maximize' THEN -1.0 END AS sgn
        FROM obs ob JOIN trials t USING (trial) JOIN experiments e ON e.experiment = t.experiment
        WHERE {num_sql('ob.value')} IS NOT NULL)
  GROUP BY trial, metric, sec""")


@register("o60_per_second_curve", with_views("SELECT * FROM curve", "obs", "trials", "experiments", extra=[CURVE_SQL]))
def q_curve(spark, d):
    c = Ctx(spark, d)
    return report.per_second_curve(c.obs, c.trials, c.experiments)


@register("o61_curve_axis_bounds", with_views(f"""
SELECT trial, count(*) AS n_points, count(DISTINCT metric) AS n_series,
  floor(min({num_sql('value')}) * 10) / 10 AS y_min, ceil(max({num_sql('value')}) * 10) / 10 AS y_max
FROM curve GROUP BY trial""", "obs", "trials", "experiments", extra=[CURVE_SQL]))
def q_bounds(spark, d):
    c = Ctx(spark, d)
    r = report.curve_bounds(report.per_second_curve(c.obs, c.trials, c.experiments))
    return r.select("trial", "n_points", "n_series", F.col("y_min").cast("double"), F.col("y_max").cast("double"))


@register("o62_nas_trial_view", with_views("""
SELECT t.experiment, t.trial, 'Generation ' || t.idx AS generation, a.architecture,
  strftime(o.ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, o.seq, o.metric, o.value
FROM (SELECT experiment, trial, state, row_number() OVER (PARTITION BY experiment ORDER BY pos) - 1 AS idx FROM trials_state) t
JOIN architectures a USING (trial) JOIN obs o ON o.trial = t.trial WHERE t.state = 'Succeeded'""",
                                           "trials_state", "architectures", "obs"))
def q_nas_view(spark, d):
    c = Ctx(spark, d)
    return report.nas_trial_view(c.trials_state, c.obs, views.architectures(spark, d).select("trial", "architecture"))


@register("o63_architecture_edges", with_views("""
SELECT trial, src, dst FROM (
  SELECT a.trial, i - 1 AS src, i AS dst FROM (SELECT trial, CAST(json(architecture) AS INTEGER[][]) AS m FROM architectures) a,
    LATERAL (SELECT unnest(range(1, len(a.m) + 1)) AS i)
  UNION ALL
  SELECT a.trial, j - 2 AS src, i AS dst FROM (SELECT trial, CAST(json(architecture) AS INTEGER[][]) AS m FROM architectures) a,
    LATERAL (SELECT unnest(range(1, len(a.m) + 1)) AS i) li, LATERAL (SELECT unnest(range(2, len(a.m[li.i]) + 1)) AS j) lj
  WHERE a.m[li.i][lj.j] = 1
  UNION ALL
  SELECT trial, len(m) + k, len(m) + k + 1 FROM (SELECT trial, CAST(json(architecture) AS INTEGER[][]) AS m FROM architectures),
    LATERAL (SELECT unnest([0, 1, 2]) AS k))""", "architectures"))
def q_arch_edges(spark, d):
    edges, _ = report.architecture_graph(views.architectures(spark, d))
    return edges.select("trial", F.col("src").cast("long").alias("src"), F.col("dst").cast("long").alias("dst"))


def _nodes_sql() -> str:
    from trialfold.plans.catalog import ORACLE
    ops = ORACLE["o47_nas_operations"]
    head, body = ops.split("\nSELECT ids.experiment", 1)
    ops_ctes = head[len("WITH "):]
    return f"""WITH {ops_ctes},
ops AS (SELECT ids.experiment{body}),
{with_views("SELECT 1", "architectures")[len("WITH "):-len(chr(10) + "SELECT 1")]},
nodes AS (SELECT a.experiment, a.trial, CAST(x.i AS BIGINT) AS node, a.m[x.i][1] AS op_id
          FROM (SELECT experiment, trial, CAST(json(architecture) AS INTEGER[][]) AS m FROM architectures) a,
               LATERAL (SELECT unnest(range(1, len(a.m) + 1)) AS i) x)
SELECT n.trial, n.node, n.op_id, '"' || coalesce(o.op_type, '')
    || CASE WHEN o.params <> '' THEN '\\n' || replace(o.params, ';', ', ') ELSE '' END || '"' AS label
FROM nodes n LEFT JOIN ops o ON o.experiment = n.experiment AND o.op_id = n.op_id"""


@register("o63b_architecture_nodes", _nodes_sql())
def q_arch_nodes(spark, d):
    _, nodes = report.architecture_graph(views.architectures(spark, d))
    ops = space.nas_operations(views.nas_ops(spark, d))
    n = nodes.join(ops, ["experiment", "op_id"], "left")
    return n.select("trial", F.col("node").cast("long").alias("node"), "op_id",
                    report.node_label(F.col("op_type"), F.col("params")).alias("label"))


@register("o64_parallel_axes", with_views(f"""
SELECT experiment, CAST(row_number() OVER (PARTITION BY experiment ORDER BY pos) - 1 AS INTEGER) AS dim, axis,
  CASE WHEN NOT categorical THEN round(mx + 0.1 * mx, 9) END AS max,
  CASE WHEN categorical THEN cats END AS categories
FROM (SELECT v.experiment, v.axis, ax.pos, ax.categorical, max({num_sql('v.value')}) AS mx,
        array_to_string(list_sort(list_distinct(list(v.value))), ',') AS cats
      FROM (SELECT tt.experiment, tt.trial, p.name AS axis,
              list_filter(a.assignments, lambda x: x.name = p.name)[1].value AS value
            FROM trial_table tt JOIN assignments a USING (trial) JOIN param_specs p ON p.experiment = tt.experiment
            UNION ALL
            SELECT tt.experiment, tt.trial, 'purchase', tt.purchase FROM trial_table tt) v
      JOIN (SELECT experiment, pos, name AS axis, type = 'categorical' AS categorical FROM param_specs
            UNION ALL SELECT experiment, 1048576, objective_metric, false FROM experiments) ax
        ON ax.experiment = v.experiment AND ax.axis = v.axis
      GROUP BY v.experiment, v.axis, ax.pos, ax.categorical)""", *_TABLE_VIEWS, "param_specs", extra=[BEST_SQL, TABLE_SQL]))
def q_parallel_axes(spark, d):
    c = Ctx(spark, d)
    tt = _table(spark, d)
    a = views.assignments(spark, d).select("trial", F.explode("assignments").alias("a")).select(
        "trial", F.col("a.name").alias("axis"), F.col("a.value").alias("value"))
    params = tt.select("experiment", "trial").join(a, "trial")
    objv = tt.select("experiment", "trial", F.lit("purchase").alias("axis"), F.col("purchase").alias("value"))
    long = params.select("experiment", "trial", "axis", "value").unionByName(objv)
    return report.parallel_axes(long, views.param_specs(spark, d), c.experiments)


@register("o65_trial_state_gauges", with_views("""
SELECT namespace, coalesce(conditions[-1].type, 'Unknown') AS last_condition, count(*) AS trials
FROM trials GROUP BY ROLLUP (namespace, coalesce(conditions[-1].type, 'Unknown'))""", "trials"))
def q_gauges(spark, d):
    return report.state_gauges(Ctx(spark, d).trials)


@register("o65b_experiment_state_gauges", with_views("""
SELECT e.namespace, v.status, count(*) AS experiments FROM verdict v JOIN experiments e USING (experiment)
GROUP BY ROLLUP (e.namespace, v.status)""", "verdict", "experiments"))
def q_exp_gauges(spark, d):
    c = Ctx(spark, d)
    v = c.verdict().join(c.experiments.select("experiment", "namespace"), "experiment")
    return v.rollup("namespace", "status").agg(F.count("*").alias("experiments"))


@register("o65c_state_change_totals", with_views("""
SELECT namespace, counter, count(*) AS total FROM (
  SELECT namespace, CASE c.type """ + " ".join(f"WHEN '{t}' THEN '{n}'" for t, n in report.COUNTERS) + """ END AS counter
  FROM (SELECT namespace, unnest(conditions) AS c FROM trials) WHERE c.status = 'True')
WHERE counter IS NOT NULL GROUP BY namespace, counter""", "trials"))
def q_totals(spark, d):
    return report.state_change_totals(Ctx(spark, d).trials)


@register("o66_status_headline", with_views("""
SELECT c.experiment,
  CASE WHEN list_filter(conditions, lambda x: x.type = 'Succeeded')[1].status = 'True' THEN list_filter(conditions, lambda x: x.type = 'Succeeded')[1].message
       WHEN list_filter(conditions, lambda x: x.type = 'Failed')[1].status = 'True' THEN list_filter(conditions, lambda x: x.type = 'Failed')[1].message
       WHEN list_filter(conditions, lambda x: x.type = 'Running')[1].status = 'True' THEN list_filter(conditions, lambda x: x.type = 'Running')[1].message
       WHEN list_filter(conditions, lambda x: x.type = 'Restarting')[1].status = 'True' THEN list_filter(conditions, lambda x: x.type = 'Restarting')[1].message
       WHEN list_filter(conditions, lambda x: x.type = 'Created')[1].status = 'True' THEN list_filter(conditions, lambda x: x.type = 'Created')[1].message
  END AS status_message,
  e.objective_metric || ' ' || CASE WHEN e.objective_type = 'maximize' THEN '>' ELSE '<' END || ' '
    || coalesce(regexp_replace(CAST(e.goal AS VARCHAR), '\\.0$', ''), 'undefined') AS goal_text
FROM econd c JOIN experiments e USING (experiment)""", "verdict", "experiments", extra=[COND_SQL]))
def q_headline(spark, d):
    c = Ctx(spark, d)
    return report.status_headline(c.verdict(), _conditions(c), c.experiments)
