"""DuckDB twins of ``plans/views.py`` (used only to build oracle SQL).

Each entry is ``name -> (sql, deps)``; ``with_views(body, ...)`` prefixes a
query body with the CTEs it needs, in dependency order.
"""

from __future__ import annotations

FLOAT_RE_SQL = r"'^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$'"


def num_sql(x: str) -> str:
    return f"(CASE WHEN regexp_matches({x}, {FLOAT_RE_SQL}) THEN TRY_CAST({x} AS DOUBLE) END)"


def tk_sql(ts: str) -> str:
    return f"coalesce(epoch_us({ts}) * 1000, -4611686018427387904)"


_STATE = """CASE c_mktsegment WHEN 'BUILDING' THEN 'Succeeded' WHEN 'AUTOMOBILE' THEN 'EarlyStopped'
  WHEN 'MACHINERY' THEN 'Failed' WHEN 'FURNITURE' THEN 'Running' WHEN 'HOUSEHOLD' THEN 'MetricsUnavailable'
  ELSE 'Pending' END"""

VIEWS: dict[str, tuple[str, list[str]]] = {
    "obs": ("""SELECT 'trial-' || user_id AS trial, event_id AS seq, ts, event_type AS metric,
        CAST(value AS VARCHAR) AS value FROM events""", []),
    "trials": (f"""SELECT trial, experiment, namespace, pos, created,
        CASE WHEN pending THEN 'Pending' ELSE st END AS declared_state,
        list_filter([
          {{'type': 'Created', 'status': 'True'}},
          CASE WHEN NOT pending THEN {{'type': 'Running', 'status': CASE WHEN running THEN 'True' ELSE 'False' END}} END,
          CASE WHEN NOT running THEN {{'type': st, 'status': 'True'}} END,
          CASE WHEN c_mktsegment = 'MACHINERY' AND c_custkey % 7 = 0 THEN {{'type': 'Killed', 'status': 'True'}} END
        ], lambda x: x IS NOT NULL) AS conditions
      FROM (SELECT *, 'trial-' || c_custkey AS trial, 'exp-' || c_nationkey AS experiment,
              'ns-' || (c_nationkey % 3) AS namespace, c_custkey AS pos,
              make_timestamp((1704067200 + c_custkey * 60) * 1000000) AS created,
              {_STATE} AS st, c_mktsegment = 'FURNITURE' AS running,
              c_mktsegment = 'FURNITURE' AND c_custkey % 5 = 0 AS pending
            FROM customer)""", []),
    "experiments": ("""SELECT 'exp-' || n_nationkey AS experiment, 'ns-' || (n_nationkey % 3) AS namespace,
        'purchase' AS objective_metric,
        CASE WHEN n_nationkey % 2 = 1 THEN 'minimize' ELSE 'maximize' END AS objective_type,
        (CASE WHEN n_nationkey % 5 = 0 THEN NULL WHEN n_nationkey % 2 = 1 THEN 0.05 ELSE 480.0 END)::DOUBLE AS goal,
        CASE WHEN n_nationkey % 2 = 1 THEN ['error'] ELSE ['view', 'click'] END AS additional_metrics,
        CASE WHEN n_nationkey % 4 = 0 THEN [{'name': 'purchase', 'value': 'latest'}]
             WHEN n_nationkey % 4 = 1 THEN [{'name': 'error', 'value': 'max'}]
             ELSE []::STRUCT(name VARCHAR, value VARCHAR)[] END AS metric_strategies,
        (20 + n_nationkey * 3)::INTEGER AS max_trial_count,
        (3 + n_nationkey % 5)::INTEGER AS parallel_trial_count,
        (CASE WHEN n_nationkey % 4 = 3 THEN NULL ELSE 5 + n_nationkey END)::INTEGER AS max_failed_trial_count,
        ['Never', 'LongRunning', 'FromVolume'][n_nationkey % 3 + 1] AS resume_policy,
        ['random', 'grid', 'hyperband', 'tpe', 'bayesianoptimization', 'cmaes', 'pbt', 'enas'][n_nationkey % 8 + 1] AS algorithm,
        n_nationkey % 6 = 5 AS suggestions_ended,
        CASE WHEN n_nationkey % 4 = 1 THEN 2 ELSE 3 END AS hb_eta,
        CAST(9 * (1 + n_nationkey % 3) AS INTEGER) AS hb_r,
        CASE n_nationkey % 3 WHEN 0 THEN 0.2 WHEN 1 THEN 0.3 ELSE 0.4 END::DOUBLE AS pbt_tau,
        CASE WHEN n_nationkey % 2 = 1 THEN 0.3 END::DOUBLE AS pbt_resample_p,
        CAST(2 + n_nationkey % 3 AS INTEGER) AS ms_start_step,
        3 AS ms_min_trials,
        0.25::DOUBLE AS tpe_gamma
      FROM nation""", []),
    "assignments": ("""SELECT 'trial-' || c_custkey AS trial, 'exp-' || c_nationkey AS experiment,
        [{'name': 'lr', 'value': '0.' || lpad(CAST(c_custkey % 97 + 1 AS VARCHAR), 3, '0')},
         {'name': 'ne', 'value': CAST(50 + (c_custkey % 10) * 50 AS VARCHAR)},
         {'name': 'booster', 'value': ['gbtree', 'dart', 'gblinear'][c_nationkey % 3 + 1]},
         {'name': 'depth', 'value': ['3', '5', '8'][c_custkey % 3 + 1]}] AS assignments
      FROM customer""", []),
    "log_lines": ("""SELECT 'trial-' || e.user_id AS trial, 'exp-' || c.c_nationkey AS experiment, e.event_id AS line_no,
        (CASE WHEN e.event_id % 50 = 0 THEN strftime(e.ts, '%Y-%m-%d %H:%M:%S.%f')
              ELSE strftime(e.ts, '%Y-%m-%dT%H:%M:%S.%f') END) || 'Z INFO ' || e.event_type
        || (CASE WHEN e.event_id % 70 = 0 THEN ' ' ELSE '=' END) || CAST(e.value AS VARCHAR) AS line
      FROM events e JOIN customer c ON e.user_id = c.c_custkey""", []),
    "json_lines": ("""SELECT 'trial-' || e.user_id AS trial, 'exp-' || c.c_nationkey AS experiment, e.event_id AS line_no,
        CASE WHEN e.event_id % 97 = 0 THEN '{"timestamp": ' ELSE
          '{' || (CASE WHEN e.event_id % 13 = 0 THEN ''
                       WHEN e.event_id % 3 = 0 THEN '"timestamp": ' || CAST(epoch_us(e.ts) // 1000000 AS VARCHAR) || '.'
                            || lpad(CAST(epoch_us(e.ts) % 1000000 AS VARCHAR), 6, '0') || ', '
                       ELSE '"timestamp": "' || strftime(e.ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z", ' END)
          || '"' || e.event_type || '": '
          || (CASE WHEN e.event_id % 11 = 0 THEN CAST(e.value AS VARCHAR) ELSE '"' || CAST(e.value AS VARCHAR) || '"' END)
          || '}' END AS line
      FROM events e JOIN customer c ON e.user_id = c.c_custkey""", []),
    "scalar_events": ("""SELECT 'trial-' || user_id AS trial,
        '/logs/trial-' || user_id || '/' || ['train', 'eval', 'misc'][event_id % 3 + 1] || '/events.out' AS path,
        event_type || CASE WHEN event_id % 2 = 0 THEN '_v1' ELSE '' END AS tag, ts AS wall_time, value
      FROM events""", []),
    "tf_metrics": ("""SELECT 'trial-' || c_custkey AS trial, unnest(['train/purchase', 'eval/click', 'view', 'misc/error']) AS metric
      FROM customer""", []),
    "range_requests": ("""SELECT 'trial-' || c_custkey AS req, 'trial-' || c_custkey AS trial,
        CASE WHEN c_custkey % 2 = 0 THEN 'purchase' END AS req_metric,
        make_timestamp((1704067200::BIGINT + 4 * 86400 + (c_custkey % 5) * 86400) * 1000000) AS start,
        CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE make_timestamp((1704067200::BIGINT + 19 * 86400) * 1000000) END AS "end"
      FROM customer""", []),
    "param_specs": ("""SELECT experiment, s.pos AS pos, s.name AS name, s.type AS type, s.min AS min, s.max AS max,
          s.step AS step, s.list AS list
      FROM (SELECT 'exp-' || n_nationkey AS experiment, unnest([
        {'pos': 0, 'name': 'lr', 'type': 'double', 'min': '0.01', 'max': '0.0' || CAST(5 + n_nationkey % 5 AS VARCHAR),
         'step': '0.01', 'list': NULL::VARCHAR[]},
        {'pos': 1, 'name': 'ne', 'type': 'int', 'min': '50', 'max': CAST(100 + (n_nationkey % 4) * 50 AS VARCHAR),
         'step': CASE WHEN n_nationkey % 3 = 0 THEN '25' ELSE '50' END, 'list': NULL::VARCHAR[]},
        {'pos': 2, 'name': 'booster', 'type': 'categorical', 'min': NULL, 'max': NULL, 'step': NULL,
         'list': ['gbtree', 'dart', 'gblinear']},
        {'pos': 3, 'name': 'depth', 'type': 'discrete', 'min': NULL, 'max': NULL, 'step': NULL,
         'list': CASE WHEN n_nationkey % 2 = 1 THEN ['3', '5', '8', '12'] ELSE ['3', '5', '8'] END}]) AS s FROM nation)""", []),
    "nas_ops": ("""SELECT experiment, o.op_pos AS op_pos, o.op_type AS op_type, o.params AS params
      FROM (SELECT 'exp-' || n_nationkey AS experiment, unnest([
        {'op_pos': 0, 'op_type': 'convolution', 'params': [
           {'name': 'filter_size', 'type': 'categorical', 'min': NULL::VARCHAR, 'max': NULL::VARCHAR, 'step': NULL::VARCHAR,
            'list': CASE WHEN n_nationkey % 2 = 1 THEN ['3', '5', '7'] ELSE ['3', '5'] END},
           {'name': 'num_filter', 'type': 'categorical', 'min': NULL, 'max': NULL, 'step': NULL,
            'list': CASE WHEN n_nationkey % 3 = 0 THEN ['32', '48', '64'] ELSE ['32', '48'] END}]},
        {'op_pos': 1, 'op_type': 'separable_convolution', 'params': [
           {'name': 'filter_size', 'type': 'categorical', 'min': NULL, 'max': NULL, 'step': NULL, 'list': ['3', '5']}]},
        {'op_pos': 2, 'op_type': 'reduction', 'params': [
           {'name': 'reduction_type', 'type': 'categorical', 'min': NULL, 'max': NULL, 'step': NULL,
            'list': ['max_pooling', 'avg_pooling']},
           {'name': 'pool_size', 'type': 'int', 'min': '2', 'max': '3', 'step': '1', 'list': NULL}]},
        {'op_pos': 3, 'op_type': 'skip_connection',
         'params': []::STRUCT(name VARCHAR, type VARCHAR, min VARCHAR, max VARCHAR, step VARCHAR, list VARCHAR[])[]}
      ]) AS o FROM nation)""", []),
    "settings_base": ("""SELECT experiment, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS pos,
          unnest(l).name AS name, unnest(l).value AS value
      FROM (SELECT 'exp-' || n_nationkey AS experiment, [{'name': 'random_state', 'value': CAST(n_nationkey AS VARCHAR)},
              {'name': 'n_startup_trials', 'value': '10'}, {'name': 'gamma', 'value': '0.25'}] AS l FROM nation)""", []),
    "settings_over": ("""SELECT experiment, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS pos,
          unnest(l).name AS name, unnest(l).value AS value
      FROM (SELECT 'exp-' || n_nationkey AS experiment, list_filter([
              CASE WHEN n_nationkey % 2 = 1 THEN {'name': 'gamma', 'value': '0.1'} END,
              CASE WHEN n_nationkey % 3 = 0 THEN {'name': 'prior_weight', 'value': '1.0'} END], lambda x: x IS NOT NULL) AS l
            FROM nation)""", []),
    "population": ("""SELECT 'trial-' || c_custkey AS trial, 'exp-' || c_nationkey AS experiment,
        CAST(floor(c_custkey / 500) AS INTEGER) AS generation,
        CASE WHEN floor(c_custkey / 500) > 0 THEN 'trial-' || (c_custkey - 500) END AS parent FROM customer""", []),
    "stop_rules": ("""SELECT 'exp-' || n_nationkey AS experiment, 0 AS rule, 'purchase' AS metric,
          CASE WHEN n_nationkey % 2 = 1 THEN '50' ELSE '20' END AS rule_value,
          CASE WHEN n_nationkey % 2 = 1 THEN 'greater' ELSE 'less' END AS comparison,
          CAST(2 + n_nationkey % 3 AS INTEGER) AS start_step FROM nation
      UNION ALL
      SELECT 'exp-' || n_nationkey, 1, 'view', '100', 'less', 1 FROM nation WHERE n_nationkey % 2 = 0""", []),
    "annotations": ("""SELECT 'trial-' || c_custkey AS trial,
        CASE WHEN c_custkey % 6 = 0 THEN 'run-' || (c_custkey % 50) END AS kfp_run FROM customer""", []),
    "architectures": ("""SELECT 'exp-' || c_nationkey AS experiment, 'trial-' || c_custkey AS trial,
        '[' || array_to_string(list_transform(range(0, 2 + c_custkey % 3), lambda i: '[' || array_to_string(
            [CAST((c_custkey * 7 + i * 3) % 11 AS VARCHAR)] || CASE WHEN i > 0 THEN list_transform(range(1, i + 1),
              lambda j: CASE WHEN (c_custkey + i * j) % 3 = 0 THEN '1' ELSE '0' END) ELSE []::VARCHAR[] END, ', ') || ']'),
          ', ') || ']' AS architecture
      FROM customer WHERE 'exp-' || c_nationkey IN (SELECT experiment FROM experiments WHERE algorithm IN ('enas', 'darts'))""",
                      ["experiments"]),
    "dataset": ("""SELECT o_orderkey AS id,
        CASE WHEN o_orderkey % 11 = 0 THEN 'Other' WHEN o_orderkey % 11 = 1 THEN NULL WHEN o_orderkey % 11 = 2 THEN 'Unknown'
             WHEN o_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
        CASE WHEN o_orderkey % 13 = 0 THEN 'No Info' WHEN o_orderkey % 17 = 0 THEN NULL
             ELSE CAST(18 + o_orderkey % 60 AS VARCHAR) END AS age,
        CASE WHEN o_orderkey % 19 = 0 THEN 'No Info' WHEN o_orderkey % 23 = 0 THEN NULL
             ELSE CAST(15 + o_orderkey % 25 AS VARCHAR) || '.' || CAST(o_orderkey % 10 AS VARCHAR) END AS bmi,
        CASE WHEN o_orderkey % 29 = 0 THEN 'No Info' WHEN o_orderkey % 31 = 0 THEN NULL
             ELSE CAST(4 + o_orderkey % 5 AS VARCHAR) || '.' || CAST(o_orderkey % 7 AS VARCHAR) END AS "HbA1c_level",
        CASE WHEN o_orderkey % 37 = 0 THEN 'No Info' WHEN o_orderkey % 41 = 0 THEN NULL
             ELSE CAST(80 + (o_orderkey * 7) % 220 AS VARCHAR) END AS blood_glucose_level,
        CASE WHEN o_orderkey % 43 = 0 THEN 'No Info' WHEN o_orderkey % 47 = 0 THEN NULL
             WHEN (4 + o_orderkey % 5) + (80 + (o_orderkey * 7) % 220) / 100.0 >= 8.0 THEN '1' ELSE '0' END AS diabetes
      FROM orders""", []),
    "jobs": ("""SELECT 'trial-' || c_custkey AS trial, CASE WHEN c_custkey % 9 = 0 THEN '' ELSE 'job-trial-' || c_custkey END AS job_name,
        CASE c_custkey % 4 WHEN 0 THEN [{'type': 'Complete', 'status': 'True'}] WHEN 1 THEN [{'type': 'Failed', 'status': 'True'}]
             WHEN 2 THEN [{'type': 'Running', 'status': 'True'}] ELSE []::STRUCT(type VARCHAR, status VARCHAR)[] END AS job_conditions
      FROM customer""", []),
    # O23 default strategies
    "strategies": ("""SELECT experiment, pos, s.name AS metric, s.value AS strategy FROM (
      SELECT experiment, CAST(generate_subscripts(slist, 1) - 1 AS INTEGER) AS pos, unnest(slist) AS s
      FROM (SELECT experiment, list_concat(metric_strategies,
              CASE WHEN NOT list_contains(list_transform(metric_strategies, lambda s: s.name), objective_metric)
                   THEN [{'name': objective_metric, 'value': dflt}] ELSE []::STRUCT(name VARCHAR, value VARCHAR)[] END,
              list_transform(list_filter(additional_metrics, lambda m: NOT list_contains(
                   list_transform(list_filter(metric_strategies, lambda s: s.name <> objective_metric), lambda s: s.name), m)),
                   lambda m: {'name': m, 'value': dflt})) AS slist
            FROM (SELECT *, CASE objective_type WHEN 'minimize' THEN 'min' WHEN 'maximize' THEN 'max' ELSE 'latest' END AS dflt
                  FROM experiments)))""", ["experiments"]),
    "trial_metrics": ("""SELECT t.trial, t.experiment, s.metric, s.strategy FROM trials t JOIN strategies s USING (experiment)""",
                      ["trials", "strategies"]),
    # O21 fold over the stored log
    "observation": (f"""SELECT tm.trial, tm.metric, coalesce(a.min, 'unavailable') AS min,
          coalesce(a.max, 'unavailable') AS max, coalesce(a.latest, 'unavailable') AS latest
      FROM trial_metrics tm LEFT JOIN (
        SELECT trial, metric,
          arg_min(value, row(num, tk, seq)) FILTER (WHERE num IS NOT NULL) AS min,
          arg_max(value, row(num, -tk, -seq)) FILTER (WHERE num IS NOT NULL) AS max,
          arg_max(value, row(tk, seq)) AS latest
        FROM (SELECT trial, metric, value, {num_sql('value')} AS num, {tk_sql('ts')} AS tk, seq FROM obs)
        GROUP BY trial, metric) a USING (trial, metric)""", ["trial_metrics", "obs"]),
    "trials_state": ("""SELECT *, CASE
          WHEN list_filter(conditions, lambda c: c.type = 'Killed')[1].status = 'True' THEN 'Killed'
          WHEN list_filter(conditions, lambda c: c.type = 'Failed')[1].status = 'True' THEN 'Failed'
          WHEN list_filter(conditions, lambda c: c.type = 'Succeeded')[1].status = 'True' THEN 'Succeeded'
          WHEN list_filter(conditions, lambda c: c.type = 'EarlyStopped')[1].status = 'True' THEN 'EarlyStopped'
          WHEN list_filter(conditions, lambda c: c.type = 'Running')[1].status = 'True' THEN 'Running'
          WHEN list_filter(conditions, lambda c: c.type = 'MetricsUnavailable')[1].status = 'True' THEN 'MetricsUnavailable'
          ELSE 'Pending' END AS state FROM trials""", ["trials"]),
    "picked": ("""SELECT o.trial, o.metric, tm.strategy, CASE tm.strategy
          WHEN 'min' THEN CASE WHEN o.min = 'unavailable' THEN o.latest ELSE o.min END
          WHEN 'max' THEN CASE WHEN o.max = 'unavailable' THEN o.latest ELSE o.max END
          WHEN 'latest' THEN o.latest END AS value
      FROM observation o JOIN trial_metrics tm USING (trial, metric)""", ["observation", "trial_metrics"]),
    "summary": ("""SELECT e.experiment,
          coalesce(count(t.trial), 0)::BIGINT AS trials,
          count(*) FILTER (WHERE t.state = 'Killed')::BIGINT AS trials_killed,
          count(*) FILTER (WHERE t.state = 'Failed')::BIGINT AS trials_failed,
          count(*) FILTER (WHERE t.state = 'Succeeded')::BIGINT AS trials_succeeded,
          count(*) FILTER (WHERE t.state = 'EarlyStopped')::BIGINT AS trials_early_stopped,
          count(*) FILTER (WHERE t.state = 'Running')::BIGINT AS trials_running,
          count(*) FILTER (WHERE t.state = 'MetricsUnavailable')::BIGINT AS trials_metrics_unavailable,
          count(*) FILTER (WHERE t.state = 'Pending')::BIGINT AS trials_pending
      FROM experiments e LEFT JOIN trials_state t USING (experiment) GROUP BY e.experiment""",
                ["experiments", "trials_state"]),
    "objective_values": ("""SELECT t.experiment, t.trial, t.pos, t.state, coalesce(CASE s.strategy
          WHEN 'min' THEN CASE WHEN o.min = 'unavailable' THEN o.latest ELSE o.min END
          WHEN 'max' THEN CASE WHEN o.max = 'unavailable' THEN o.latest ELSE o.max END
          WHEN 'latest' THEN o.latest END, 'unavailable') AS value
      FROM trials_state t JOIN experiments e USING (experiment)
      LEFT JOIN strategies s ON s.experiment = t.experiment AND s.metric = e.objective_metric
      LEFT JOIN observation o ON o.trial = t.trial AND o.metric = e.objective_metric""",
                         ["trials_state", "experiments", "strategies", "observation"]),
    "best": (f"""SELECT e.experiment, coalesce(g.bn_trial, g.bt_trial) AS best_trial,
          CASE WHEN g.bn_trial IS NOT NULL THEN g.bn_value ELSE g.bt_value END AS best_value,
          CASE WHEN e.goal IS NULL THEN false
               WHEN e.objective_type = 'minimize' THEN coalesce(g.min_x <= e.goal, false)
               WHEN e.objective_type = 'maximize' THEN coalesce(g.max_x >= e.goal, false)
               ELSE false END AS goal_reached
      FROM experiments e LEFT JOIN (
        SELECT experiment,
          arg_max(trial, row(sx, -pos)) FILTER (WHERE x IS NOT NULL) AS bn_trial,
          arg_max(value, row(sx, -pos)) FILTER (WHERE x IS NOT NULL) AS bn_value,
          arg_max(trial, pos) FILTER (WHERE x IS NULL) AS bt_trial,
          arg_max(value, pos) FILTER (WHERE x IS NULL) AS bt_value,
          min(x) FILTER (WHERE objective_type = 'minimize') AS min_x,
          max(x) FILTER (WHERE objective_type = 'maximize') AS max_x
        FROM (SELECT ov.*, e2.objective_type, {num_sql('ov.value')} AS x,
                (CASE e2.objective_type WHEN 'minimize' THEN -1.0 WHEN 'maximize' THEN 1.0 ELSE 0.0 END) * {num_sql('ov.value')} AS sx
              FROM objective_values ov JOIN experiments e2 USING (experiment) WHERE ov.value <> 'unavailable')
        GROUP BY experiment) g USING (experiment)""", ["experiments", "objective_values"]),
    "verdict": ("""SELECT *, CASE WHEN reason = 'ExperimentFailed' THEN 'Failed' WHEN reason = 'ExperimentRunning' THEN 'Running'
            ELSE 'Succeeded' END AS status
      FROM (SELECT s.*, b.best_trial, b.best_value, coalesce(b.goal_reached, false) AS goal_reached,
          s.trials_succeeded + s.trials_failed + s.trials_killed + s.trials_early_stopped + s.trials_metrics_unavailable AS completed,
          s.trials_failed + s.trials_metrics_unavailable AS failed_total,
          s.trials_pending + s.trials_running AS active,
          CASE WHEN coalesce(b.goal_reached, false) THEN 'ExperimentGoalReached'
               WHEN e.max_failed_trial_count IS NOT NULL AND s.trials_failed + s.trials_metrics_unavailable <> 0
                    AND s.trials_failed + s.trials_metrics_unavailable >= e.max_failed_trial_count THEN 'ExperimentFailed'
               WHEN e.max_trial_count IS NOT NULL AND s.trials_succeeded + s.trials_failed + s.trials_killed
                    + s.trials_early_stopped + s.trials_metrics_unavailable >= e.max_trial_count THEN 'ExperimentMaxTrialsReached'
               WHEN coalesce(e.suggestions_ended, false) AND s.trials_pending + s.trials_running = 0 THEN 'ExperimentSuggestionEndReached'
               ELSE 'ExperimentRunning' END AS reason
        FROM summary s LEFT JOIN best b USING (experiment) JOIN experiments e USING (experiment))""",
                ["summary", "best", "experiments"]),
    "budget": ("""SELECT experiment, active, completed_budget,
          (CASE WHEN active > par THEN active - par ELSE 0 END)::BIGINT AS delete_count,
          (CASE WHEN active < par THEN greatest(CASE WHEN mt IS NULL THEN par ELSE least(mt - completed_budget, par) END - active, 0)
                ELSE 0 END)::BIGINT AS add_count
      FROM (SELECT s.experiment, s.trials_pending + s.trials_running AS active,
              s.trials_succeeded + s.trials_failed + s.trials_killed + s.trials_early_stopped AS completed_budget,
              e.parallel_trial_count AS par, e.max_trial_count AS mt
            FROM summary s JOIN experiments e USING (experiment))""", ["summary", "experiments"]),
    "available": ("""SELECT t.trial, EXISTS (SELECT 1 FROM observation o WHERE o.trial = t.trial
            AND o.metric = e.objective_metric AND o.latest <> 'unavailable') AS available
      FROM trials t JOIN experiments e USING (experiment)""", ["trials", "experiments", "observation"]),
}


def with_views(body: str, *names: str, extra: list[tuple[str, str]] | None = None) -> str:
    """Prefix ``body`` with the CTEs of the named views (dependencies first)
    and then the ``extra`` (name, sql) CTEs in the given order."""
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for d in VIEWS[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    ctes = [f"{n} AS ({VIEWS[n][0]})" for n in order] + [f"{n} AS ({q})" for n, q in (extra or [])]
    if not ctes:
        return body
    return "WITH " + ",\n".join(ctes) + "\n" + body
