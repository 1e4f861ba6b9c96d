"""Registered queries: search guidance (O56a–O56h)."""

from __future__ import annotations

from pyspark.sql import functions as F

from trialfold.functions.exprs import num
from trialfold.operators import guide, space, state
from trialfold.plans import views
from trialfold.plans.catalog import register
from trialfold.plans.oracle import num_sql, tk_sql, with_views
from trialfold.plans.pipelines import Ctx
from trialfold.plans.q_space import MD5U
from trialfold.session import cut_lineage


def _hb_sched(experiments):
    return guide.hyperband_schedule(experiments)


@register("o56a_hyperband_schedule", with_views("""
SELECT experiment, CAST(s AS INTEGER) AS s, CAST(i AS INTEGER) AS i, n, round(r, 9) AS r, n_i,
  CAST(ceil(n_i / eta) AS BIGINT) AS keep, CAST(floor(r * pow(eta, i)) AS BIGINT) AS r_i
FROM (SELECT *, CAST(ceil(n * pow(eta, -i)) AS BIGINT) AS n_i FROM (
  SELECT *, unnest(range(0, s + 1)) AS i FROM (
    SELECT *, CAST(ceil((s_max + 1)::DOUBLE * (pow(eta, s) / (s + 1)::DOUBLE)) AS BIGINT) AS n, rmax * pow(eta, -s) AS r FROM (
      SELECT *, unnest(range(s_max, -1, -1)) AS s FROM (
        SELECT experiment, hb_eta::DOUBLE AS eta, hb_r::DOUBLE AS rmax,
          CAST(len(list_filter(range(1, 64), lambda x: pow(hb_eta, x) <= hb_r)) AS INTEGER) AS s_max FROM experiments)))))""",
                                                  "experiments"))
def q_hb_schedule(spark, d):
    return _hb_sched(Ctx(spark, d).experiments)


def _eligible(c: Ctx):
    """Trials an algorithm sees (O39 filter): no MetricsUnavailable, no
    early-stopped without observation."""
    ts = c.trials_state.join(c.available, "trial")
    return ts.filter((F.col("state") != "MetricsUnavailable") & ~((F.col("state") == "EarlyStopped") & ~F.col("available")))


@register("o56b_rung_promotion", with_views(f"""
SELECT top.experiment, CAST(prank AS INTEGER) AS rank, top.trial,
  array_to_string(list_transform(a.assignments, lambda z: z.name || '=' ||
    CASE WHEN z.name = 'ne' THEN CAST(top.r AS VARCHAR) ELSE z.value END), ',') AS assignments, NULL::VARCHAR AS error
FROM (SELECT *, row_number() OVER (PARTITION BY experiment ORDER BY CASE WHEN objective_type = 'maximize' THEN -x ELSE x END,
        created, pos) AS prank FROM lo WHERE experiment IN (SELECT experiment FROM chk WHERE ok)) top
JOIN assignments a USING (trial) WHERE prank <= k
UNION ALL
SELECT experiment, NULL, NULL, NULL, 'trials of the rung are not all completed' FROM chk WHERE NOT ok""",
    "trials_state", "available", "objective_values", "experiments", "assignments", extra=[
        ("rq", """SELECT experiment, parallel_trial_count * 3 AS m, CAST(ceil(parallel_trial_count * 3 / hb_eta) AS BIGINT) AS k,
                  hb_r AS r FROM experiments"""),
        ("elig", """SELECT t.* FROM trials_state t JOIN available a USING (trial)
                    WHERE t.state = 'Succeeded' AND a.available OR CAST(substr(t.experiment, 5) AS INTEGER) % 3 = 0
                      AND t.state <> 'MetricsUnavailable' AND NOT (t.state = 'EarlyStopped' AND NOT a.available)"""),
        ("last", """SELECT * FROM (SELECT t.experiment, t.trial, t.created, t.pos, rq.m, rq.k, rq.r,
                      row_number() OVER (PARTITION BY t.experiment ORDER BY t.created DESC, t.pos DESC) AS rn
                    FROM elig t JOIN rq USING (experiment)) WHERE rn <= m"""),
        ("lo", f"""SELECT l.*, ov.state, ov.value, e.objective_type, {num_sql('ov.value')} AS x
                  FROM last l JOIN objective_values ov USING (trial) JOIN experiments e ON e.experiment = l.experiment"""),
        ("chk", "SELECT experiment, bool_and(state = 'Succeeded' AND x IS NOT NULL) AS ok FROM lo GROUP BY experiment")]))
def q_rung_promotion(spark, d):
    c = Ctx(spark, d)
    ov = state.objective_values(c.observation, c.trials_state, c.strategies, c.experiments)
    rq = c.experiments.select("experiment", (F.col("parallel_trial_count") * 3).alias("m"),
                              F.ceil(F.col("parallel_trial_count") * 3 / F.col("hb_eta")).cast("long").alias("k"),
                              F.col("hb_r").alias("r"))
    # every third experiment has its unfinished trials in the rung, which stops the promotion
    third = F.substring("experiment", 5, 9).cast("int") % 3 == 0
    rung = _eligible(c).filter(third | (F.col("state") == "Succeeded") & F.col("available"))
    return guide.rung_promotion(ov, rung, views.assignments(spark, d), c.experiments, rq)


def _pool(c: Ctx):
    ov = state.objective_values(c.observation, c.trials_state, c.strategies, c.experiments)
    e = c.experiments.select("experiment", "objective_type")
    x = num("value")
    p = (ov.filter((F.col("state") == "Succeeded") & x.isNotNull())
         .join(e, "experiment")
         .select("experiment", "trial", (F.when(F.col("objective_type") == "minimize", F.lit(-1.0)).otherwise(F.lit(1.0)) * x)
                 .alias("metric_value")))
    cnt = p.groupBy("experiment").agg(F.count("*").alias("count"))
    return p.join(cnt, "experiment")


PBT_SQL = [
    ("pool", f"""SELECT ov.experiment, ov.trial, e.pbt_tau AS tau,
        (CASE WHEN e.objective_type = 'minimize' THEN -1.0 ELSE 1.0 END) * {num_sql('ov.value')} AS metric_value
      FROM objective_values ov JOIN experiments e USING (experiment)
      WHERE ov.state = 'Succeeded' AND {num_sql('ov.value')} IS NOT NULL"""),
    ("ranked", """SELECT *, row_number() OVER (PARTITION BY experiment ORDER BY metric_value) - 1 AS idx,
        count(*) OVER (PARTITION BY experiment) AS n FROM pool"""),
    ("qlow", """SELECT experiment, min(metric_value) + (first(tau * (n - 1)) - floor(first(tau * (n - 1))))
                  * (max(metric_value) - min(metric_value)) AS low
                FROM ranked WHERE idx = floor(tau * (n - 1)) OR idx = ceil(tau * (n - 1)) GROUP BY experiment"""),
    ("qhigh", """SELECT experiment, min(metric_value) + (first((1 - tau) * (n - 1)) - floor(first((1 - tau) * (n - 1))))
                  * (max(metric_value) - min(metric_value)) AS high
                FROM ranked WHERE idx = floor((1 - tau) * (n - 1)) OR idx = ceil((1 - tau) * (n - 1)) GROUP BY experiment"""),
    ("roled", f"""SELECT p.*, l.low, h.high, CASE WHEN p.metric_value < l.low THEN 'exploit' ELSE 'explore' END AS role,
        p.metric_value >= l.low AND p.metric_value >= h.high AS upper,
        {MD5U.format(args="0, 'pbt', p.trial")} AS shuffle, c.count
      FROM pool p JOIN qlow l USING (experiment) JOIN qhigh h USING (experiment)
      JOIN (SELECT experiment, count(*) AS count FROM pool GROUP BY experiment) c USING (experiment)"""),
    ("split", """SELECT r.experiment, r.trial, r.metric_value, round(r.low, 9) AS low, round(r.high, 9) AS high, r.role, r.upper,
        CASE WHEN r.role = 'exploit' THEN rn <= floor(r.count * r.tau)
             ELSE rn <= r.count - least(coalesce(ne.n_exploit, 0), CAST(floor(r.count * r.tau) AS BIGINT)) END AS kept
      FROM (SELECT *, row_number() OVER (PARTITION BY experiment, role ORDER BY shuffle, trial) AS rn FROM roled) r
      LEFT JOIN (SELECT experiment, count(*) AS n_exploit FROM roled WHERE role = 'exploit' GROUP BY experiment) ne
        USING (experiment)"""),
]


@register("o56c_pbt_truncation_split", with_views("SELECT * FROM split", "objective_values", "experiments", extra=PBT_SQL))
def q_pbt_split(spark, d):
    c = Ctx(spark, d)
    return guide.pbt_split(_pool(c), c.experiments)


def _assign_long(spark, d):
    a = views.assignments(spark, d)
    return a.select("trial", F.explode("assignments").alias("a")).select("trial", "a.name", "a.value")


@register("o56d_pbt_next_generation", with_views(f"""
SELECT x.experiment, x.parent, x.kind, pop.generation + 1 AS generation, x.name, round(x.value_num, 9) AS value_num, x.value_text
FROM (
  SELECT ex.experiment, ex.trial AS parent, 'exploit' AS kind, al.name,
    CASE WHEN ps.type IN ('int', 'double') THEN TRY_CAST(al.value AS DOUBLE) END AS value_num,
    CASE WHEN ps.type NOT IN ('int', 'double') THEN al.value END AS value_text
  FROM (SELECT s.*, nu.n_up, CAST(floor({MD5U.format(args="0, 'upper', s.trial")} * nu.n_up) + 1 AS INTEGER) AS up_idx
        FROM split s JOIN (SELECT experiment, count(*) AS n_up FROM split WHERE upper GROUP BY experiment) nu USING (experiment)
        WHERE s.kept AND s.role = 'exploit') ex
  JOIN (SELECT experiment, trial AS up_trial, CAST(row_number() OVER (PARTITION BY experiment ORDER BY trial) AS INTEGER) AS up_idx
        FROM split WHERE upper) up USING (experiment, up_idx)
  JOIN al ON al.trial = up.up_trial JOIN param_specs ps ON ps.experiment = ex.experiment AND ps.name = al.name
  UNION ALL
  SELECT experiment, trial, 'explore', name,
    CASE WHEN is_num THEN CASE WHEN resample THEN lo + floor(u3 * ceil((hi + st / 2 - lo) / st)) * st WHEN keep THEN v
                               ELSE greatest(lo, least(hi, CASE WHEN type = 'int' THEN floor(floor(v) * factor) ELSE v * factor END)) END END,
    CASE WHEN NOT is_num THEN CASE WHEN resample THEN list[CAST(floor(u3 * len(list)) + 1 AS BIGINT)] WHEN keep THEN value
                                   ELSE list[CAST(CASE WHEN idx0 >= len(list) THEN 0 WHEN idx0 < 0 THEN len(list) + idx0 ELSE idx0 END + 1 AS BIGINT)]
                              END END
  FROM (SELECT s.experiment, s.trial, al.name, al.value, ps.type, ps.list, TRY_CAST(ps.min AS DOUBLE) AS lo,
          TRY_CAST(ps.max AS DOUBLE) AS hi, TRY_CAST(ps.step AS DOUBLE) AS st, TRY_CAST(al.value AS DOUBLE) AS v,
          ps.type IN ('int', 'double') AS is_num,
          CASE WHEN {MD5U.format(args="0, 'perturb', s.trial, al.name")} < 0.5 THEN 0.8 ELSE 1.2 END AS factor,
          list_position(ps.list, al.value) - 1 + CASE WHEN {MD5U.format(args="0, 'perturb', s.trial, al.name")} < 0.5 THEN -1 ELSE 1 END AS idx0,
          {MD5U.format(args="0, 'pick', s.trial, al.name")} AS u3,
          e.pbt_resample_p IS NOT NULL AND {MD5U.format(args="0, 'resample', s.trial, al.name")} < e.pbt_resample_p AS resample,
          e.pbt_resample_p IS NOT NULL AND NOT ({MD5U.format(args="0, 'resample', s.trial, al.name")} < e.pbt_resample_p) AS keep
        FROM split s JOIN al USING (trial) JOIN param_specs ps ON ps.experiment = s.experiment AND ps.name = al.name
        JOIN experiments e ON e.experiment = s.experiment
        WHERE s.kept AND s.role = 'explore')
) x JOIN population pop ON pop.trial = x.parent""", "objective_values", "experiments", "param_specs", "population",
    "assignments", extra=PBT_SQL + [
        ("al", "SELECT trial, unnest(assignments).name AS name, unnest(assignments).value AS value FROM assignments")]))
def q_pbt_next(spark, d):
    c = Ctx(spark, d)
    split = guide.pbt_split(_pool(c), c.experiments)
    return guide.pbt_next_generation(split, _assign_long(spark, d), views.param_specs(spark, d), c.experiments,
                                     views.population(spark, d))


@register("o56e_pbt_requeue", with_views("""
SELECT t.experiment, t.trial, p.parent, p.generation FROM trials_state t JOIN population p USING (trial)
WHERE t.state IN ('Killed', 'Failed')""", "trials_state", "population"))
def q_pbt_requeue(spark, d):
    c = Ctx(spark, d)
    return guide.pbt_requeue(c.trials_state, views.population(spark, d).select("trial", "parent", "generation"))


@register("o56e_lineage_roots", with_views("""
SELECT * FROM (
  WITH RECURSIVE chain(trial, anc, depth) AS (
    SELECT trial, trial, 0 FROM population
    UNION ALL
    SELECT c.trial, p.parent, c.depth + 1 FROM chain c JOIN population p ON p.trial = c.anc WHERE p.parent IS NOT NULL)
  SELECT trial, arg_max(anc, depth) AS root, CAST(max(depth) AS INTEGER) AS depth FROM chain GROUP BY trial)""", "population"))
def q_lineage(spark, d):
    pop = views.population(spark, d).select("trial", "parent")
    r = guide.lineage_roots(pop, checkpoint=cut_lineage)
    return r.withColumn("depth", F.col("depth").cast("int"))


def _tpe_inputs(spark, d, n_candidates: int = 8):
    c = Ctx(spark, d)
    specs = views.param_specs(spark, d)
    bounds = space.space_bounds(specs)
    ov = state.objective_values(c.observation, c.trials_state, c.strategies, c.experiments)
    prior = ov.filter(F.col("state") == "Succeeded").select("trial", "value")
    enc = space.encode_trials(views.assignments(spark, d), prior, specs, c.experiments)
    tr = space.min_max_scale(enc, bounds).join(enc.select("trial", "dim", "y"), ["trial", "dim"])
    tr = tr.filter(F.col("y").isNotNull()).select("experiment", F.col("trial").alias("id"), "dim",
                                                  F.col("scaled").alias("x"), "y")
    counts = c.experiments.select("experiment", F.lit(n_candidates).alias("n"))
    smp = space.uniform_sample(specs, counts, seed=7)
    val = F.coalesce(F.col("value_text"), F.col("value_num").cast("string"))
    ca = smp.groupBy("experiment", "sample").agg(
        F.sort_array(F.collect_list(F.struct("pos", F.struct(F.col("name"), val.alias("value")).alias("a")))).alias("l"))
    # candidate ids are unique across experiments (the encoder joins on the id)
    ca = ca.select("experiment", F.concat(F.lit("cand-"), F.col("experiment"), F.lit("-"), F.col("sample").cast("string")).alias("trial"),
                   F.transform("l", lambda z: z["a"]).alias("assignments"))
    cobj = ca.select("trial", F.lit("0").alias("value"))
    cenc = space.encode_trials(ca, cobj, specs, c.experiments)
    cs = space.min_max_scale(cenc, bounds).select("experiment", F.col("trial").alias("id"), "dim",
                                                  F.least(F.greatest("scaled", F.lit(0.0)), F.lit(1.0)).alias("x"))
    return cs, tr


def _tpe_sql() -> str:
    from trialfold.plans.catalog import ORACLE
    from trialfold.plans.q_space import ENC_SQL
    u = ORACLE["o43_o44_uniform_sample"]
    body = "SELECT experiment, sample, pos, name," + u.split("\nSELECT experiment, sample, pos, name,", 1)[1]
    body = body.replace("concat_ws('|', 0, s.experiment", "concat_ws('|', 7, s.experiment").replace(
        "range(1, parallel_trial_count + 1)", "range(1, 9)")
    bnd = """SELECT experiment, CAST(off AS INTEGER) AS dim,
          CASE WHEN type = 'discrete' THEN list_min(list_transform(list, lambda v: TRY_CAST(v AS DOUBLE))) ELSE TRY_CAST(min AS DOUBLE) END AS lo,
          CASE WHEN type = 'discrete' THEN list_max(list_transform(list, lambda v: TRY_CAST(v AS DOUBLE))) ELSE TRY_CAST(max AS DOUBLE) END AS hi
        FROM sp WHERE type <> 'categorical'
        UNION ALL
        SELECT experiment, CAST(off + generate_subscripts(list, 1) - 1 AS INTEGER), 0.0, 1.0 FROM sp WHERE type = 'categorical'"""
    scaled = "CASE WHEN b.hi - b.lo = 0 THEN 0.0 ELSE (e.x - b.lo) / (b.hi - b.lo) END"
    return with_views("""
SELECT experiment, candidate, round(score, 9) AS score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY experiment ORDER BY score DESC, candidate) AS rank FROM (
    SELECT cb.experiment, cb.candidate,
      sum(ln((coalesce(h.cg, 0) + 1.0 / 20) / (ng.n_good + 1.0)) - ln((coalesce(h.cb, 0) + 1.0 / 20) / (ng.n_bad + 1.0))) AS score
    FROM (SELECT experiment, id AS candidate, dim, CAST(least(floor(x * 20), 19) AS INTEGER) AS bin FROM cs) cb
    LEFT JOIN h ON h.experiment = cb.experiment AND h.dim = cb.dim AND h.bin = cb.bin
    JOIN ng ON ng.experiment = cb.experiment
    GROUP BY cb.experiment, cb.candidate))
WHERE rank <= 2""", "param_specs", "objective_values", "assignments", "experiments", extra=ENC_SQL + [
        ("bnd", bnd),
        ("tr", f"""SELECT e.experiment, e.trial AS id, e.dim, {scaled} AS x,
                    CASE WHEN ex.objective_type = 'minimize' THEN -TRY_CAST(p.obj AS DOUBLE) ELSE TRY_CAST(p.obj AS DOUBLE) END AS y
                  FROM enc e JOIN bnd b USING (experiment, dim) JOIN prior p ON p.trial = e.trial
                  JOIN experiments ex ON ex.experiment = e.experiment"""),
        ("trv", "SELECT * FROM tr WHERE y IS NOT NULL"),
        ("smp", body),
        ("cenc", """SELECT s.experiment, 'cand-' || s.experiment || '-' || s.sample AS id, CAST(sp.off AS INTEGER) AS dim,
                      coalesce(s.value_num, TRY_CAST(s.value_text AS DOUBLE)) AS x
                    FROM smp s JOIN sp ON sp.experiment = s.experiment AND sp.name = s.name WHERE sp.type <> 'categorical'
                    UNION ALL
                    SELECT s.experiment, 'cand-' || s.experiment || '-' || s.sample, CAST(sp.off + generate_subscripts(sp.list, 1) - 1 AS INTEGER),
                      CASE WHEN unnest(sp.list) = s.value_text THEN 1.0 ELSE 0.0 END
                    FROM smp s JOIN sp ON sp.experiment = s.experiment AND sp.name = s.name WHERE sp.type = 'categorical'"""),
        ("cs", f"SELECT e.experiment, e.id, e.dim, least(greatest({scaled}, 0.0), 1.0) AS x FROM cenc e JOIN bnd b USING (experiment, dim)"),
        ("ty", "SELECT DISTINCT experiment, id, y FROM trv"),
        ("lab", """SELECT ty.experiment, ty.id, ty.y >= q.thr AS good FROM ty
                   JOIN (SELECT experiment, quantile_cont(y, 0.75) AS thr FROM ty GROUP BY experiment) q USING (experiment)"""),
        ("ng", """SELECT experiment, count(*) FILTER (WHERE good) AS n_good, count(*) FILTER (WHERE NOT good) AS n_bad
                  FROM lab GROUP BY experiment"""),
        ("h", """SELECT t.experiment, t.dim, CAST(least(floor(t.x * 20), 19) AS INTEGER) AS bin,
                   count(*) FILTER (WHERE l.good) AS cg, count(*) FILTER (WHERE NOT l.good) AS cb
                 FROM trv t JOIN lab l USING (experiment, id) GROUP BY ALL""")])


@register("o56f_tpe_candidate_scoring", _tpe_sql())
def q_tpe(spark, d):
    cand, tr = _tpe_inputs(spark, d)
    return guide.tpe_scores(cand, tr, gamma=0.25, top=2)


@register("o56g_median_stop_rule", with_views(f"""
SELECT e.experiment, count(*) AS n_trials,
  CASE WHEN count(*) >= e.ms_min_trials THEN round(avg(a.avg), 9) END AS rule_value,
  CASE WHEN e.objective_type = 'maximize' THEN 'less' ELSE 'greater' END AS comparison
FROM (SELECT experiment, trial, avg(x) AS avg FROM (
        SELECT o.trial, t.experiment, {num_sql('o.value')} AS x, e.ms_start_step,
          row_number() OVER (PARTITION BY o.trial ORDER BY {tk_sql('o.ts')}, o.seq) AS rn
        FROM obs o JOIN trials_state t USING (trial) JOIN experiments e ON e.experiment = t.experiment
        WHERE t.state = 'Succeeded' AND o.metric = e.objective_metric AND {num_sql('o.value')} IS NOT NULL)
      WHERE rn <= ms_start_step GROUP BY experiment, trial) a
JOIN experiments e USING (experiment) GROUP BY e.experiment, e.ms_min_trials, e.objective_type""",
                                                "obs", "trials_state", "experiments"))
def q_median_stop(spark, d):
    c = Ctx(spark, d)
    return guide.median_stop_rule(c.obs, c.trials_state, c.experiments)


@register("o56h_stop_rule_evaluation", with_views(f"""
SELECT t.trial, coalesce(per.n_met, 0) = nr.n_rules AS stopped,
  CASE WHEN coalesce(per.n_met, 0) = nr.n_rules THEN per.last.seq END AS stop_seq
FROM trials t JOIN (SELECT experiment, count(*) AS n_rules FROM stop_rules GROUP BY experiment) nr USING (experiment)
LEFT JOIN (SELECT trial, count(*) AS n_met, max(first) AS last FROM (
    SELECT trial, rule, min({{'tk': tk, 'seq': seq}}) AS first FROM (
      SELECT t.trial, r.rule, r.rule_value, r.comparison, r.start_step, {num_sql('ob.value')} AS x, {tk_sql('ob.ts')} AS tk, ob.seq,
        row_number() OVER (PARTITION BY t.trial, r.rule ORDER BY {tk_sql('ob.ts')}, ob.seq) AS rn
      FROM obs ob JOIN trials t USING (trial) JOIN stop_rules r ON r.experiment = t.experiment AND r.metric = ob.metric)
    WHERE rn >= start_step AND coalesce(CASE comparison WHEN 'equal' THEN x = TRY_CAST(rule_value AS DOUBLE)
        WHEN 'less' THEN x < TRY_CAST(rule_value AS DOUBLE) WHEN 'greater' THEN x > TRY_CAST(rule_value AS DOUBLE) END, false)
    GROUP BY trial, rule) GROUP BY trial) per USING (trial)""", "obs", "trials", "stop_rules"))
def q_stop_rules(spark, d):
    c = Ctx(spark, d)
    return guide.evaluate_stop_rules(c.obs, c.trials, views.stop_rules(spark, d))

