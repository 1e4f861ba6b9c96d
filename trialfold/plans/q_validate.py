"""Registered queries: specification and setting validation (O55, O56),
run configuration routing (O08)."""

from __future__ import annotations

from pyspark.sql import functions as F

from trialfold.operators import space, validate
from trialfold.plans import views
from trialfold.plans.catalog import register
from trialfold.plans.oracle import with_views
from trialfold.plans.pipelines import Ctx
from trialfold.plans.q_sources import scratch
from trialfold.sources import files

SPECS_SQL = [
    ("ps", """SELECT p.* REPLACE (
          CASE WHEN name = 'ne' AND CAST(substr(experiment, 5) AS INTEGER) % 6 = 1 THEN ['1'] ELSE list END AS list,
          CASE WHEN name = 'booster' AND CAST(substr(experiment, 5) AS INTEGER) % 10 = 3 THEN '0' ELSE min END AS min)
        FROM param_specs p
        UNION ALL
        SELECT p.* REPLACE (4 AS pos) FROM param_specs p
        WHERE name = 'lr' AND CAST(substr(experiment, 5) AS INTEGER) % 14 = 13"""),
    ("pl", """SELECT experiment, list({'name': name, 'type': type, 'min': min, 'max': max, 'step': step, 'list': list}
          ORDER BY pos) AS params FROM ps GROUP BY experiment"""),
    ("specs", """SELECT 'exp-' || k AS experiment,
        CASE WHEN k % 9 = 4 THEN 'Exp-' || k ELSE 'exp-' || k END AS name,
        CASE WHEN k % 11 = 3 THEN 0 ELSE 20 + k * 3 END AS max_trial_count,
        CASE WHEN k % 7 = 2 THEN 100 ELSE 3 + k % 5 END AS parallel_trial_count,
        CASE WHEN k % 13 = 5 THEN -1 ELSE 5 + k END AS max_failed_trial_count,
        CASE WHEN k % 12 = 6 THEN 'maximise' WHEN k % 2 = 1 THEN 'minimize' ELSE 'maximize' END AS objective_type,
        CASE WHEN k % 10 = 8 THEN '' ELSE 'purchase' END AS objective_metric,
        CASE WHEN k % 8 = 7 THEN ['purchase'] WHEN k % 2 = 1 THEN ['error'] ELSE ['view', 'click'] END AS additional_metrics,
        CASE WHEN k % 15 = 14 THEN '' ELSE ['random', 'grid', 'hyperband', 'tpe', 'bayesianoptimization', 'cmaes', 'pbt',
             'enas'][k % 8 + 1] END AS algorithm,
        CASE WHEN k % 10 = 9 THEN 'Sometimes' ELSE ['Never', 'LongRunning', 'FromVolume'][k % 3 + 1] END AS resume_policy,
        k % 8 = 7 AS is_nas, pl.params
      FROM (SELECT n_nationkey AS k FROM nation) LEFT JOIN pl ON pl.experiment = 'exp-' || k"""),
    ("pm", """SELECT experiment, list_filter(list_transform(params, lambda x, i: 'parameter ' || (i - 1) || ': ' || CASE
          WHEN x.type NOT IN ('int', 'double', 'categorical', 'discrete', 'unknown') THEN 'type not known: ' || x.type
          WHEN concat(x.min, x.max, x.step) = '' AND coalesce(len(x.list), 0) = 0 THEN 'nothing to search'
          WHEN x.type IN ('int', 'double') AND len(x.list) > 0 THEN 'a range takes no list'
          WHEN x.type IN ('int', 'double') AND concat(x.min, x.max) = '' THEN 'a range needs a bound'
          WHEN x.type IN ('categorical', 'discrete') AND concat(x.min, x.max, x.step) <> '' THEN 'a list takes no range' END),
          lambda m: m IS NOT NULL)[1] AS first_param,
        list_filter(list_transform(params, lambda x: x.name), lambda nm, i: len(list_filter(list_transform(params, lambda y: y.name),
          lambda m: m = nm)) > 1 AND list_position(list_transform(params, lambda y: y.name), nm) = i) AS dup
      FROM specs"""),
]

RULES_SQL = """[
  CASE WHEN NOT regexp_matches(name, '^[a-z]([-a-z0-9]*[a-z0-9])?') THEN 'name: malformed' END,
  CASE WHEN max_failed_trial_count < 0 THEN 'failed limit: negative' END,
  CASE WHEN max_trial_count <= 0 THEN 'trial limit: not positive' END,
  CASE WHEN parallel_trial_count <= 0 THEN 'parallel limit: not positive' END,
  CASE WHEN max_failed_trial_count > max_trial_count THEN 'failed limit: above the trial limit' END,
  CASE WHEN parallel_trial_count > max_trial_count THEN 'parallel limit: above the trial limit' END,
  CASE WHEN objective_type NOT IN ('minimize', 'maximize') THEN 'objective: no direction' END,
  CASE WHEN coalesce(objective_metric, '') = '' THEN 'objective: no metric' END,
  CASE WHEN list_contains(additional_metrics, objective_metric) THEN 'objective: its metric is listed twice' END,
  CASE WHEN coalesce(algorithm, '') = '' THEN 'algorithm: missing' END,
  CASE WHEN coalesce(resume_policy, '') NOT IN ('', 'Never', 'LongRunning', 'FromVolume') THEN 'resume policy: not known: ' || resume_policy END,
  CASE WHEN coalesce(len(params), 0) = 0 AND NOT is_nas THEN 'search space: missing' END,
  CASE WHEN coalesce(len(params), 0) > 0 AND is_nas THEN 'search space: given twice' END,
  first_param,
  CASE WHEN len(dup) > 0 THEN 'parameter names: repeated: ' || array_to_string(dup, ',') END]"""


@register("o55_spec_validation", with_views(f"""
SELECT * FROM (
  SELECT experiment, CAST(generate_subscripts(msgs, 1) - 1 AS INTEGER) AS rule, unnest(msgs) AS message FROM (
    SELECT s.experiment, {RULES_SQL} AS msgs FROM specs s JOIN pm USING (experiment)))
WHERE message IS NOT NULL""", "param_specs", extra=SPECS_SQL))
def q_spec_validation(spark, d):
    return validate.spec_violations(views.experiment_specs(spark, d))


def _first_error_sql() -> str:
    from trialfold.plans.catalog import ORACLE
    return f"SELECT experiment, arg_min(message, rule) AS first_error FROM ({ORACLE['o55_spec_validation']}) GROUP BY experiment"


@register("o55b_spec_first_error", _first_error_sql())
def q_first_error(spark, d):
    """The error the reference's validator returns: the first failing rule."""
    return validate.first_errors(validate.spec_violations(views.experiment_specs(spark, d)))


# The rules as conditions under which a setting is at fault, apart from the operator's table.
_FAULT = """CASE
  WHEN algorithm IN ('tpe', 'multivariate-tpe') AND name IN ('n_startup_trials', 'n_ei_candidates', 'random_state')
    OR algorithm IN ('random', 'grid', 'cmaes', 'bayesianoptimization') AND name = 'random_state'
    OR algorithm = 'bayesianoptimization' AND name = 'n_initial_points'
    THEN CASE WHEN i IS NULL THEN nan WHEN i < 0 THEN far END
  WHEN algorithm = 'tpe' AND name = 'n_EI_candidates' OR algorithm = 'medianstop' AND name IN ('min_trials_required', 'start_step')
    THEN CASE WHEN i IS NULL THEN nan WHEN i < 1 THEN far END
  WHEN algorithm = 'tpe' AND name = 'gamma' THEN CASE WHEN x IS NULL THEN nan WHEN x <= 0 OR x >= 1 THEN far END
  WHEN algorithm = 'tpe' AND name = 'prior_weight' THEN CASE WHEN x IS NULL THEN nan WHEN x <= 0 THEN far END
  WHEN algorithm = 'cmaes' AND name = 'sigma' OR algorithm = 'hyperband' AND name = 'r_l'
    THEN CASE WHEN x IS NULL THEN nan WHEN x < 0 THEN far END
  WHEN algorithm = 'hyperband' AND name = 'eta' THEN CASE WHEN x IS NULL THEN nan END
  WHEN algorithm = 'pbt' AND name = 'n_population' THEN CASE WHEN i IS NULL THEN nan WHEN i < 5 THEN far END
  WHEN algorithm = 'pbt' AND name IN ('truncation_threshold', 'resample_probability')
    THEN CASE WHEN x IS NULL THEN nan WHEN x < 0 OR x > 1 THEN far END
  WHEN algorithm = 'cmaes' AND name = 'restart_strategy' THEN CASE WHEN value NOT IN ('ipop', 'None', 'none') THEN other END
  WHEN algorithm = 'bayesianoptimization' AND name = 'base_estimator' THEN CASE WHEN value NOT IN ('GP', 'RF', 'ET', 'GBRT') THEN other END
  WHEN algorithm = 'bayesianoptimization' AND name = 'acq_func'
    THEN CASE WHEN value NOT IN ('gp_hedge', 'LCB', 'EI', 'PI', 'EIps', 'PIps') THEN other END
  WHEN algorithm = 'bayesianoptimization' AND name = 'acq_optimizer' THEN CASE WHEN value NOT IN ('auto', 'sampling', 'lbfgs') THEN other END
  WHEN algorithm NOT IN ('hyperband', 'pbt', 'enas', 'darts', 'sobol') THEN 'not a setting of ' || algorithm END"""


@register("o56_algorithm_setting_validation", with_views(f"""
SELECT experiment, setting, message FROM (
  SELECT experiment, name AS setting, {_FAULT} AS message
  FROM (SELECT o.*, e.algorithm, TRY_CAST(o.value AS BIGINT) AS i, TRY_CAST(o.value AS DOUBLE) AS x, 'not a number: ' || o.value AS nan,
          'outside its range: ' || o.value AS far, 'not a choice: ' || o.value AS other
        FROM overlay o JOIN experiments e USING (experiment)))
WHERE message IS NOT NULL
UNION ALL
SELECT experiment, '' AS setting, message FROM (
  SELECT e.experiment, unnest([
    CASE WHEN e.algorithm = 'cmaes' AND coalesce(nn.n_num, 0) < 2
         THEN 'cmaes: fewer than two numeric parameters' END,
    CASE WHEN e.algorithm = 'hyperband' AND len(list_filter(['r_l', 'resource_name'],
           lambda x: NOT list_contains(coalesce(nm.names, []::VARCHAR[]), x))) > 0 THEN 'hyperband: lacks ' || array_to_string(list_filter(['r_l', 'resource_name'],
           lambda x: NOT list_contains(coalesce(nm.names, []::VARCHAR[]), x)), ', ') END,
    CASE WHEN e.algorithm = 'pbt' AND len(list_filter(['suggestion_trial_dir', 'n_population', 'truncation_threshold'],
           lambda x: NOT list_contains(coalesce(nm.names, []::VARCHAR[]), x))) > 0
         THEN 'pbt: lacks ' || array_to_string(list_filter(['suggestion_trial_dir', 'n_population',
           'truncation_threshold'], lambda x: NOT list_contains(coalesce(nm.names, []::VARCHAR[]), x)), ', ') END]) AS message
  FROM experiments e
  LEFT JOIN (SELECT experiment, list(DISTINCT name) AS names FROM overlay GROUP BY experiment) nm USING (experiment)
  LEFT JOIN (SELECT experiment, count(*) AS n_num FROM param_specs WHERE type IN ('int', 'double') GROUP BY experiment) nn
    USING (experiment))
WHERE message IS NOT NULL""", "settings_base", "settings_over", "experiments", "param_specs", extra=[
    ("overlay", """SELECT experiment, name, value FROM (
        SELECT coalesce(b.experiment, o.experiment) AS experiment, coalesce(b.name, o.name) AS name, coalesce(o.value, b.value) AS value
        FROM settings_base b FULL OUTER JOIN settings_over o ON b.experiment = o.experiment AND b.name = o.name)""")]))
def q_setting_validation(spark, d):
    c = Ctx(spark, d)
    ov = space.settings_overlay(views.settings_base(spark, d), views.settings_over(spark, d))
    per_setting = validate.setting_violations(ov.select("experiment", "name", "value"), c.experiments, validate.setting_rules(spark))
    per_algorithm = validate.algorithm_requirements(ov, c.experiments, views.param_specs(spark, d))
    return per_setting.unionByName(per_algorithm)


@register("o08_run_config_route", """
SELECT run, method, key, value FROM (
  SELECT run, method, unnest(['datasets_from_pvc', 'learning_rate_min', 'max_trial_counts', 'n_estimators_min']) AS key,
    unnest([CAST(pvc AS VARCHAR), CAST(lr AS VARCHAR), CAST(mt AS VARCHAR), CAST(ne AS VARCHAR)]) AS value
  FROM (SELECT 'run-' || (c_custkey % 1000) AS run, ['xgboost', 'random_forest', 'knn', 'lr', 'svm'][c_custkey % 5 + 1] AS method,
          0.2::DOUBLE + (c_custkey % 5) * 0.1::DOUBLE AS lr, 1000 + c_custkey * 10 AS ne,
          c_custkey % 2 = 0 AS pvc, 5 + c_custkey AS mt FROM customer))
WHERE method IN ('xgboost', 'random_forest', 'knn', 'lr')""")
def q_run_config(spark, d):
    """A configuration object for each customer, in documents of many runs: one object a line."""
    k = F.col("c_custkey")
    method = views._pick(k, ["xgboost", "random_forest", "knn", "lr", "svm"])
    cfg = views.table(spark, d, "customer").select(
        F.concat(F.lit("run-"), (k % 1000).cast("string")).alias("run"), method.alias("method"), (F.lit(0.2) + (k % 5) * F.lit(0.1)).alias("learning_rate_min"),
        (F.lit(1000) + k * 10).alias("n_estimators_min"), (k % 2 == 0).alias("datasets_from_pvc"), (F.lit(5) + k).alias("max_trial_counts"))
    p = scratch(spark, "run-config")
    cfg.select(F.to_json(F.struct(*cfg.columns)).alias("value")).write.text(p)
    return files.read_run_config(spark, p, one_a_line=True)


# ------------------------------------------- templates, collectors and edits

def _job(k):
    return F.concat(F.lit("job-"), k.cast("string"))


def _job_templates(spark, d):
    """A template for each customer, with a fault by the key."""
    k = F.col("c_custkey")

    def tp(name, reference):
        return F.struct(F.lit(name).alias("name"), F.lit(reference).alias("reference"))

    more = (F.when(k % 7 == 1, tp("", "ne")).when(k % 7 == 2, tp("rate", "ne")).when(k % 7 == 3, tp("steps", "lr"))
            .when(k % 7 == 4, tp("steps", "momentum")).when(k % 7 == 5, tp("unused", "ne"))
            .when(k % 7 == 6, tp("steps", "${trialSpec.Labels[team]}")).otherwise(tp("steps", "ne")))
    text = F.concat(F.lit("run --lr=${trialParameters.rate} --ne=${trialParameters.steps}"),
                    F.when(k % 5 == 0, F.lit(" --x=${trialParameters.ghost}")).otherwise(F.lit("")))
    return views.table(spark, d, "customer").select(_job(k).alias("experiment"), text.alias("template"),
                                                    F.array(tp("rate", "lr"), more).alias("trial_parameters"))


def _job_specs(spark, d):
    k = F.col("c_custkey")
    return views.table(spark, d, "customer").filter(k % 6 != 0).select(
        _job(k).alias("experiment"), F.explode(F.array(F.lit("lr"), F.lit("ne"))).alias("name"))


@register("o55c_template_validation", """
WITH p AS (
  SELECT 'job-' || c_custkey AS experiment, c_custkey % 6 <> 0 AS has_space, c_custkey % 5 = 0 AS ghost, 0 AS place, 'rate' AS name, 'lr' AS ref
  FROM customer
  UNION ALL
  SELECT 'job-' || c_custkey, c_custkey % 6 <> 0, c_custkey % 5 = 0, 1, ['steps', '', 'rate', 'steps', 'steps', 'unused', 'steps'][c_custkey % 7 + 1],
    ['ne', 'ne', 'ne', 'lr', 'momentum', 'ne', '${trialSpec.Labels[team]}'][c_custkey % 7 + 1] FROM customer),
r AS (SELECT *, row_number() OVER (PARTITION BY experiment, name ORDER BY place) AS nth_name,
        row_number() OVER (PARTITION BY experiment, ref ORDER BY place) AS nth_ref FROM p)
SELECT * FROM (SELECT experiment, place, CASE WHEN name = '' THEN 'name or reference malformed' WHEN nth_name > 1 THEN 'name repeated: ' || name
    WHEN nth_ref > 1 THEN 'reference repeated' WHEN has_space AND ref NOT IN ('lr', 'ne') AND NOT starts_with(ref, '$') THEN 'refers to nothing: ' || ref
    WHEN name NOT IN ('rate', 'steps', CASE WHEN ghost THEN 'ghost' ELSE 'rate' END) THEN 'not in the template: ' || name END AS message FROM r)
WHERE message IS NOT NULL
UNION ALL
SELECT experiment, -1, 'placeholders without a parameter: ' || string_agg(t, ',' ORDER BY t) FROM (
  SELECT DISTINCT experiment, unnest(CASE WHEN ghost THEN ['rate', 'steps', 'ghost'] ELSE ['rate', 'steps'] END) AS t FROM p) u
WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.experiment = u.experiment AND p.name = u.t) GROUP BY experiment""")
def q_template_validation(spark, d):
    return validate.template_violations(_job_templates(spark, d), _job_specs(spark, d))


_KINDS = ["None", "StdOut", "File", "TensorFlowEvent", "PrometheusMetric", "Custom", "Socket"]


@register("o55d_collector_validation", """
SELECT * FROM (SELECT experiment, unnest([
    CASE WHEN kind = 'Socket' THEN 'collector: kind not known' END,
    CASE WHEN kind = 'File' AND (src <> 'File' OR path NOT LIKE '/%') THEN 'collector: needs the absolute path of a file' END,
    CASE WHEN kind = 'File' AND form NOT IN ('TEXT', 'JSON') THEN 'collector: file format not known' END,
    CASE WHEN kind = 'File' AND form = 'JSON' AND filtered THEN 'collector: JSON takes no filter' END,
    CASE WHEN kind = 'TensorFlowEvent' AND (src <> 'Directory' OR path NOT LIKE '/%') THEN 'collector: needs the absolute path of a folder' END,
    CASE WHEN kind = 'TensorFlowEvent' AND form <> '' THEN 'collector: events take no format' END,
    CASE WHEN kind = 'PrometheusMetric' AND k % 4 < 3 THEN 'collector: port not positive' END,
    CASE WHEN kind = 'PrometheusMetric' AND path NOT LIKE '/%' THEN 'collector: path must start with a slash' END,
    CASE WHEN kind = 'Custom' AND k % 2 = 0 THEN 'collector: custom container missing' END,
    CASE WHEN kind = 'Custom' AND src <> '' AND (path NOT LIKE '/%' OR src = 'Socket') THEN 'collector: custom source malformed' END,
    CASE WHEN k % 13 = 1 THEN 'early stopping: algorithm missing' WHEN k % 13 = 2 THEN 'early stopping: algorithm not known' END]) AS message
  FROM (SELECT c_custkey AS k, 'job-' || c_custkey AS experiment,
          ['None', 'StdOut', 'File', 'TensorFlowEvent', 'PrometheusMetric', 'Custom', 'Socket'][c_custkey % 7 + 1] AS kind,
          ['File', 'Directory', 'Socket', ''][c_custkey % 4 + 1] AS src, CASE WHEN c_custkey % 3 = 0 THEN 'logs/out' ELSE '/logs/out' END AS path,
          ['TEXT', 'JSON', '', 'CSV', ''][c_custkey % 5 + 1] AS form, c_custkey % 2 = 1 AS filtered FROM customer))
WHERE message IS NOT NULL""")
def q_collector_validation(spark, d):
    k = F.col("c_custkey")
    c = views.table(spark, d, "customer").select(
        _job(k).alias("experiment"), views._pick(k, _KINDS).alias("kind"),
        F.when(k % 4 < 3, views._pick(k % 4, ["File", "Directory", "Socket"])).alias("source_kind"),
        F.when(k % 3 == 0, F.lit("logs/out")).otherwise(F.lit("/logs/out")).alias("path"),
        F.when(k % 5 != 4, views._pick(k % 5, ["TEXT", "JSON", "", "CSV"])).alias("format"),
        F.when(k % 2 == 1, F.array(F.lit(r"(\w+)=(\d+)"))).alias("filters"),
        views._pick(k % 4, ["0", "-1", "http", "8080"]).alias("port"), F.when(k % 2 == 1, F.lit(True)).alias("custom"),
        F.when(k % 13 == 0, F.lit("medianstop")).when(k % 13 == 1, F.lit("")).when(k % 13 == 2, F.lit("asha")).alias("stopping"))
    return validate.collector_violations(c)


@register("o55e_edit_validation", """
SELECT * FROM (SELECT 'job-' || k AS experiment, unnest([
    CASE WHEN edit > 0 AND k % 3 = 0 AND k % 2 = 1 THEN 'edit: completed and not restartable' END,
    CASE WHEN edit > 0 AND (CASE WHEN edit = 1 THEN 40 ELSE 10 END) <= k % 50 THEN 'edit: trial limit not above the trials' END,
    CASE WHEN edit = 3 THEN 'edit: only the limits may change' END]) AS message
  FROM (SELECT c_custkey AS k, c_custkey % 4 AS edit FROM customer))
WHERE message IS NOT NULL""")
def q_edit_validation(spark, d):
    """Nothing changes, the trial limit, the parallel limit or the algorithm."""
    k = F.col("c_custkey")
    c = views.table(spark, d, "customer").withColumn("experiment", _job(k))
    old = c.select("experiment", F.lit(10).alias("max_trial_count"), F.lit(2).alias("parallel_trial_count"),
                   F.lit(None).cast("int").alias("max_failed_trial_count"), F.lit("random").alias("algorithm"))
    new = c.select("experiment", F.when(k % 4 == 1, 40).otherwise(10).alias("max_trial_count"),
                   F.when(k % 4 == 2, 3).otherwise(2).alias("parallel_trial_count"),
                   F.lit(None).cast("int").alias("max_failed_trial_count"), F.when(k % 4 == 3, "tpe").otherwise("random").alias("algorithm"))
    status = c.select("experiment", (k % 3 == 0).alias("completed"), (k % 2 == 0).alias("restartable"), (k % 50).alias("trials"))
    return validate.edit_violations(old, new, status)
