"""Registered queries: search spaces, sampling, matching, templates."""

from __future__ import annotations

from pyspark.sql import functions as F

from trialfold.operators import space, state
from trialfold.plans import views
from trialfold.plans.catalog import register
from trialfold.plans.oracle import with_views
from trialfold.plans.pipelines import Ctx

MD5U = "(('0x' || substr(md5(concat_ws('|', {args})), 1, 8))::BIGINT / 4294967296.0)"

AXES_SQL = ("axes", """
  SELECT experiment, pos, name, type,
    CASE WHEN type = 'int' THEN list_transform(range(n_int), lambda i: {'num': CAST(lo_i + i * step_i AS DOUBLE),
                                                                         'text': CAST(lo_i + i * step_i AS VARCHAR)})
         WHEN type = 'double' AND st_d IS NOT NULL THEN list_transform(range(n_dbl), lambda i: {'num': lo_d + i * st_d,
                                                                                               'text': NULL::VARCHAR})
         WHEN type IN ('categorical', 'discrete') THEN list_transform(coalesce(list, []::VARCHAR[]),
                                                              lambda v: {'num': TRY_CAST(v AS DOUBLE), 'text': v})
    END AS vals
  FROM (SELECT *, CASE WHEN n_raw > 0 AND lo_d + (n_raw - 1) * st_d > hi_d THEN n_raw - 1 ELSE n_raw END AS n_dbl
        FROM (SELECT *, TRY_CAST(greatest(ceil((hi_i + 1 - lo_i) / step_i), 0) AS BIGINT) AS n_int,
                     TRY_CAST(greatest(ceil((hi_d + st_d - lo_d) / st_d), 0) AS BIGINT) AS n_raw
              FROM (SELECT *, TRY_CAST(min AS BIGINT) AS lo_i, TRY_CAST(max AS BIGINT) AS hi_i,
                       TRY_CAST(coalesce(nullif(step, ''), '1') AS BIGINT) AS step_i,
                       TRY_CAST(min AS DOUBLE) AS lo_d, TRY_CAST(max AS DOUBLE) AS hi_d, TRY_CAST(step AS DOUBLE) AS st_d
                    FROM param_specs)))""")


def _specs(spark, d):
    return views.param_specs(spark, d)


@register("o40_grid_axis_values", with_views("""
SELECT experiment, pos, name, CAST(generate_subscripts(vals, 1) - 1 AS INTEGER) AS idx,
  round(unnest(vals).num, 9) AS value_num, unnest(vals).text AS value_text FROM axes""", "param_specs", extra=[AXES_SQL]))
def q_axis_values(spark, d):
    x = space.axis_rows(space.grid_axes(_specs(spark, d)))
    return x.select("experiment", "pos", "name", F.col("idx").cast("int").alias("idx"),
                    F.round("num", 9).alias("value_num"), F.col("text").alias("value_text"))


@register("o41_grid_product", with_views("""
SELECT i.experiment, i.combo, s.pos, s.name, round(s.vals[(i.combo // s.stride) % s.size + 1].num, 9) AS value_num,
  s.vals[(i.combo // s.stride) % s.size + 1].text AS value_text
FROM (SELECT experiment, unnest(range(n)) AS combo FROM tot) i JOIN strides s USING (experiment)""", "param_specs", extra=[
    AXES_SQL,
    ("strides", """SELECT *, len(vals) AS size, coalesce(product(len(vals)) OVER (PARTITION BY experiment ORDER BY pos DESC
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1)::BIGINT AS stride FROM axes"""),
    ("tot", "SELECT experiment, product(len(vals))::BIGINT AS n FROM axes GROUP BY experiment")]))
def q_grid_product(spark, d):
    g = space.grid_product(space.grid_axes(_specs(spark, d)))
    return g.withColumn("value_num", F.round("value_num", 9))


@register("o42_grid_size_check", with_views("""
SELECT t.experiment, t.n AS grid_size, e.max_trial_count, NOT t.has_error AND e.max_trial_count <= t.n AS valid
FROM (SELECT experiment, product(len(vals))::BIGINT AS n, bool_or(type = 'double' AND vals IS NULL) AS has_error
      FROM axes GROUP BY experiment) t JOIN experiments e USING (experiment)""", "param_specs", "experiments", extra=[AXES_SQL]))
def q_grid_size(spark, d):
    c = Ctx(spark, d)
    return space.grid_size(space.grid_axes(_specs(spark, d)), c.experiments)


@register("o42b_wide_grids", """
SELECT experiment, type, size, error IS NOT NULL AS failed, grid_size FROM (
  SELECT 'exp-c' || c_custkey AS experiment, k, CASE k WHEN 0 THEN 'int' WHEN 1 THEN 'double' WHEN 2 THEN 'int' ELSE 'double' END AS type,
    CASE k WHEN 0 THEN 3000000000 + c_custkey WHEN 1 THEN 10000000001 WHEN 2 THEN 1000000 ELSE CASE WHEN c_custkey % 5 = 0 THEN 0 ELSE 1 + c_nationkey END END AS size,
    CASE WHEN k = 3 AND c_custkey % 5 = 0 THEN 'step' END AS error,
    CASE WHEN c_custkey % 5 = 0 THEN 0 ELSE 9223372036854775807 END AS grid_size
  FROM customer, range(4) t(k))""")
def q_wide_grids(spark, d):
    """Axes too long to list, for every customer: answered by size, and a bad step fails alone."""
    c = views.table(spark, d, "customer").select(F.concat(F.lit("exp-c"), F.col("c_custkey").cast("string")).alias("experiment"), "c_custkey", "c_nationkey")
    no_list = F.lit(None).cast("array<string>")

    def axis(pos, kind, low, high, step):
        texts = [x.cast("string") if not isinstance(x, str) else F.lit(x) for x in (low, high, step)]
        return F.struct(F.lit(pos).alias("pos"), F.lit(f"p{pos}").alias("name"), F.lit(kind).alias("type"), texts[0].alias("min"),
                        texts[1].alias("max"), texts[2].alias("step"), no_list.alias("list"))

    step = F.when(F.col("c_custkey") % 5 == 0, F.lit("0")).otherwise(F.lit("0.5"))
    specs = c.select("experiment", F.explode(F.array(
        axis(0, "int", "1", F.lit(3_000_000_000).cast("long") + F.col("c_custkey"), "1"), axis(1, "double", "0", "1e10", "1"),
        axis(2, "int", "-5", F.lit(999_994), "1"), axis(3, "double", "0", (F.col("c_nationkey") / 2).cast("string"), step))).alias("a")).select("experiment", "a.*")
    axes = space.grid_axes(specs)
    sizes = space.grid_size(axes, c.select("experiment", F.lit(1).alias("max_trial_count")))
    return axes.join(sizes, "experiment").select("experiment", "type", "size", F.col("error").isNotNull().alias("failed"), "grid_size")


def _counts(c: Ctx):
    return c.experiments.select("experiment", F.col("parallel_trial_count").alias("n"))


@register("o43_o44_uniform_sample", with_views(f"""
SELECT experiment, sample, pos, name,
  round(CASE type WHEN 'int' THEN round_even(x, 0) WHEN 'double' THEN x WHEN 'discrete' THEN TRY_CAST(disc AS DOUBLE) END, 9) AS value_num,
  CASE type WHEN 'int' THEN CAST(CAST(round_even(x, 0) AS BIGINT) AS VARCHAR) WHEN 'discrete' THEN disc
            WHEN 'categorical' THEN list[list_position(us, list_max(us))] END AS value_text
FROM (SELECT *, list_sort(list_transform(list, lambda v, i: {{'dist': abs(TRY_CAST(v AS DOUBLE) - x), 'i': i, 'v': v}}))[1].v AS disc
      FROM (SELECT *, lo + us[1] * (hi - lo) AS x FROM (
        SELECT s.experiment, s.sample, b.*, list_transform(range(b.dims),
               lambda dd: {MD5U.format(args="0, s.experiment, s.sample, b.pos, dd")}) AS us
        FROM (SELECT experiment, unnest(range(1, parallel_trial_count + 1)) AS sample FROM experiments) s
        JOIN (SELECT ps.*, CASE WHEN type IN ('int', 'double') THEN TRY_CAST(min AS DOUBLE)
                                WHEN type = 'discrete' THEN list_min(list_transform(list, lambda v: TRY_CAST(v AS DOUBLE))) END AS lo,
                           CASE WHEN type IN ('int', 'double') THEN TRY_CAST(max AS DOUBLE)
                                WHEN type = 'discrete' THEN list_max(list_transform(list, lambda v: TRY_CAST(v AS DOUBLE))) END AS hi,
                           CASE WHEN type = 'categorical' THEN len(list) ELSE 1 END AS dims
              FROM param_specs ps) b USING (experiment))))""", "param_specs", "experiments"))
def q_uniform_sample(spark, d):
    c = Ctx(spark, d)
    r = space.uniform_sample(_specs(spark, d), _counts(c))
    return r.withColumn("sample", F.col("sample").cast("long"))


_MODES_SQL = " ".join(
    f"WHEN l.library = '{lib}' AND ps.type = '{t}' THEN '{m}'"
    for lib, mm in space.LIBRARY_MODES.items() for t, m in mm.items())


@register("o45_library_sample", with_views(f"""
SELECT library, experiment, sample, pos, name, mode,
  round(CASE WHEN mode = 'choice' THEN TRY_CAST(choice AS DOUBLE) ELSE x END, 9) AS value_num,
  CASE WHEN mode = 'choice' THEN choice END AS value_text
FROM (SELECT *, list[CAST(floor(u * len(list)) + 1 AS BIGINT)] AS choice,
        CASE WHEN mode = 'uniform' THEN lo + u * (hi - lo)
             WHEN mode = 'int_uniform' THEN lo + floor(u * (hi - lo + 1))
             WHEN mode = 'quantised' THEN round_even((lo + u * (hi - lo)) / q, 0) * q
             WHEN mode = 'log_uniform' THEN exp(ln(lo) + u * (ln(hi) - ln(lo)))
             WHEN mode = 'stepped' AND has_step THEN lo + floor(u * (floor((hi - lo) / q) + 1)) * q
             WHEN mode = 'stepped' AND type = 'int' THEN lo + floor(u * (hi - lo + 1))
             WHEN mode = 'stepped' THEN lo + u * (hi - lo) END AS x
      FROM (SELECT l.library, s.experiment, s.sample, ps.pos, ps.name, ps.type, ps.list,
              CASE {_MODES_SQL} END AS mode,
              {MD5U.format(args="0, l.library, s.experiment, s.sample, ps.pos")} AS u,
              TRY_CAST(ps.min AS DOUBLE) AS lo, TRY_CAST(ps.max AS DOUBLE) AS hi,
              coalesce(TRY_CAST(nullif(ps.step, '') AS DOUBLE), 1.0) AS q, coalesce(ps.step, '') <> '' AS has_step
            FROM (SELECT unnest(['optuna', 'hyperopt', 'skopt', 'goptuna']) AS library) l,
                 (SELECT experiment, unnest(range(1, parallel_trial_count + 1)) AS sample FROM experiments) s
            JOIN param_specs ps USING (experiment)))""", "param_specs", "experiments"))
def q_library_sample(spark, d):
    c = Ctx(spark, d)
    out = None
    for lib in space.LIBRARY_MODES:
        r = space.library_sample(_specs(spark, d), _counts(c), lib).withColumn("library", F.lit(lib))
        out = r if out is None else out.unionByName(r)
    return out.withColumn("sample", F.col("sample").cast("long"))


#: Direction integers of the first four dimensions, by each one's own recurrence.
SOBOL_SQL = ("direction", """SELECT dim, k, m FROM (
    WITH RECURSIVE r AS (
      SELECT 1 AS k, 1::BIGINT AS a1, 0::BIGINT AS a2, 1::BIGINT AS b1, 0::BIGINT AS b2, 1::BIGINT AS c1, 3::BIGINT AS c2, 1::BIGINT AS c3
      UNION ALL
      SELECT k + 1, xor(2 * a1, a1), a2, CASE WHEN k = 1 THEN 3 ELSE xor(xor(2 * b1, 4 * b2), b2) END, b1,
             c2, c3, xor(xor(4 * c2, 8 * c1), c1) FROM r WHERE k < 16)
    SELECT 1 AS dim, k, 1::BIGINT AS m FROM r UNION ALL SELECT 2, k, a1 FROM r UNION ALL SELECT 3, k, b1 FROM r
    UNION ALL SELECT 4, k, c1 FROM r)""")


@register("o46_sobol_sample", with_views("""
SELECT experiment, sample, pos, name, round(u, 12) AS u,
  round(CASE WHEN type IN ('categorical', 'discrete') THEN TRY_CAST(list[CAST(floor(u * len(list)) + 1 AS BIGINT)] AS DOUBLE)
             ELSE lo + floor(u * (floor((hi - lo) / st) + 1)) * st END, 9) AS value_num,
  CASE WHEN type IN ('categorical', 'discrete') THEN list[CAST(floor(u * len(list)) + 1 AS BIGINT)] END AS value_text
FROM (SELECT s.experiment, s.sample, p.pos, p.name, p.type, p.list, TRY_CAST(p.min AS DOUBLE) AS lo, TRY_CAST(p.max AS DOUBLE) AS hi,
        TRY_CAST(p.step AS DOUBLE) AS st, coalesce(x.xi, 0) / 4294967296.0 AS u
      FROM (SELECT experiment, unnest(range(parallel_trial_count)) AS sample FROM experiments) s
      JOIN param_specs p USING (experiment)
      LEFT JOIN (SELECT n.sample, d.dim, bit_xor(d.m << (32 - d.k)) AS xi
                 FROM (SELECT unnest(range(64)) AS sample) n JOIN direction d
                 ON (xor(n.sample, n.sample >> 1) >> (d.k - 1)) & 1 = 1 GROUP BY n.sample, d.dim) x
        ON x.sample = s.sample AND x.dim = p.pos + 1)""", "param_specs", "experiments", extra=[SOBOL_SQL]))
def q_sobol(spark, d):
    c = Ctx(spark, d)
    r = space.sobol_sample(_specs(spark, d), _counts(c))
    return r.withColumn("sample", F.col("sample").cast("long"))


# ---------------------------------------------------------------- NAS

@register("o47_nas_operations", with_views("""
SELECT ids.experiment, ids.base + ids.i AS op_id, ids.op_type,
  coalesce(string_agg(st.name || '=' || st.vals[(ids.i // st.stride) % st.size + 1], ';' ORDER BY st.ppos), '') AS params
FROM (SELECT experiment, op_pos, op_type, base, unnest(range(n)) AS i FROM base) ids
LEFT JOIN st ON st.experiment = ids.experiment AND st.op_pos = ids.op_pos
GROUP BY ids.experiment, ids.base, ids.i, ids.op_type""", "nas_ops", extra=[
    ("p", """SELECT experiment, op_pos, op_type, generate_subscripts(params, 1) - 1 AS ppos, unnest(params) AS p FROM nas_ops"""),
    ("ax", """SELECT experiment, op_pos, op_type, ppos, p.name AS name,
        CASE WHEN p.type = 'int' THEN list_transform(range(greatest(ceil((TRY_CAST(p.max AS BIGINT) + 1 - TRY_CAST(p.min AS BIGINT))
                  / TRY_CAST(coalesce(nullif(p.step, ''), '1') AS BIGINT)), 0)::BIGINT),
                  lambda i: CAST(TRY_CAST(p.min AS BIGINT) + i * TRY_CAST(coalesce(nullif(p.step, ''), '1') AS BIGINT) AS VARCHAR))
             ELSE p.list END AS vals FROM p"""),
    ("st", """SELECT *, len(vals) AS size, coalesce(product(len(vals)) OVER (PARTITION BY experiment, op_pos ORDER BY ppos DESC
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1)::BIGINT AS stride FROM ax"""),
    ("opn", """SELECT o.experiment, o.op_pos, o.op_type, coalesce(a.n, 1)::BIGINT AS n FROM nas_ops o
              LEFT JOIN (SELECT experiment, op_pos, product(len(vals)) AS n FROM ax GROUP BY ALL) a USING (experiment, op_pos)"""),
    ("base", """SELECT *, coalesce(sum(n) OVER (PARTITION BY experiment ORDER BY op_pos
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS base FROM opn""")]))
def q_nas_operations(spark, d):
    return space.nas_operations(views.nas_ops(spark, d)).withColumn("op_id", F.col("op_id").cast("long"))


@register("o48_nas_primitives", with_views("""
SELECT experiment, op_pos, CAST(generate_subscripts(vals, 1) - 1 AS INTEGER) AS idx,
  CASE WHEN op_type = 'skip_connection' THEN op_type ELSE op_type || '_' || unnest(vals) || 'x' || unnest(vals) END AS primitive
FROM (SELECT experiment, op_pos, op_type, CASE WHEN op_type = 'skip_connection' THEN [NULL::VARCHAR]
        ELSE params[1].list END AS vals FROM nas_ops)""", "nas_ops"))
def q_nas_primitives(spark, d):
    return space.nas_primitives(views.nas_ops(spark, d))


@register("o49_settings_overlay", with_views("""
SELECT experiment, CAST(row_number() OVER (PARTITION BY experiment ORDER BY k) - 1 AS INTEGER) AS pos, name, value FROM (
  SELECT coalesce(b.experiment, o.experiment) AS experiment, coalesce(b.name, o.name) AS name,
         CASE WHEN b.pos IS NOT NULL THEN b.pos ELSE coalesce(nb.nb, 0) + o.pos END AS k, coalesce(o.value, b.value) AS value
  FROM settings_base b FULL OUTER JOIN settings_over o ON b.experiment = o.experiment AND b.name = o.name
  LEFT JOIN (SELECT experiment, count(*) AS nb FROM settings_base GROUP BY experiment) nb
    ON nb.experiment = coalesce(b.experiment, o.experiment))""", "settings_base", "settings_over"))
def q_settings(spark, d):
    return space.settings_overlay(views.settings_base(spark, d), views.settings_over(spark, d))


# ------------------------------------------------------- encode / scale

ENC_SQL = [
    ("sp", """SELECT *, coalesce(sum(CASE WHEN type = 'categorical' THEN len(list) ELSE 1 END) OVER (PARTITION BY experiment
                ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM param_specs"""),
    ("prior", """SELECT ov.experiment, ov.trial, ov.value AS obj FROM objective_values ov WHERE ov.state = 'Succeeded'"""),
    ("av", """SELECT a.experiment, a.trial, unnest(a.assignments).name AS name, unnest(a.assignments).value AS value
              FROM assignments a WHERE a.trial IN (SELECT trial FROM prior)"""),
    ("enc", """SELECT av.experiment, av.trial, CAST(sp.off AS INTEGER) AS dim, TRY_CAST(av.value AS DOUBLE) AS x
               FROM av JOIN sp USING (experiment, name) WHERE sp.type <> 'categorical'
               UNION ALL
               SELECT av.experiment, av.trial, CAST(sp.off + generate_subscripts(sp.list, 1) - 1 AS INTEGER) AS dim,
                      CASE WHEN unnest(sp.list) = av.value THEN 1.0 ELSE 0.0 END AS x
               FROM av JOIN sp USING (experiment, name) WHERE sp.type = 'categorical'"""),
]


def _encoded(spark, d):
    c = Ctx(spark, d)
    ov = state.objective_values(
        c.observation, c.trials_state, c.strategies, c.experiments)
    prior = ov.filter(F.col("state") == "Succeeded").select("trial", "value")
    a = views.assignments(spark, d)
    return space.encode_trials(a, prior, _specs(spark, d), c.experiments)


@register("o50_encode_prior_trials", with_views(f"""
SELECT enc.experiment, enc.trial, enc.dim, enc.x,
  CASE WHEN e.objective_type = 'minimize' THEN -TRY_CAST(p.obj AS DOUBLE) ELSE TRY_CAST(p.obj AS DOUBLE) END AS y
FROM enc JOIN prior p USING (trial) JOIN experiments e ON e.experiment = enc.experiment""",
                                                 "param_specs", "objective_values", "assignments", "experiments", extra=ENC_SQL))
def q_encode(spark, d):
    return _encoded(spark, d)


@register("o51_min_max_scale", with_views("""
SELECT enc.experiment, enc.trial, enc.dim, round(CASE WHEN b.hi - b.lo = 0 THEN 0.0 ELSE (enc.x - b.lo) / (b.hi - b.lo) END, 9) AS scaled
FROM enc JOIN (
  SELECT experiment, CAST(off AS INTEGER) AS dim, CASE WHEN type = 'discrete' THEN list_min(list_transform(list, lambda v: TRY_CAST(v AS DOUBLE)))
         ELSE TRY_CAST(min AS DOUBLE) END AS lo,
       CASE WHEN type = 'discrete' THEN list_max(list_transform(list, lambda v: TRY_CAST(v AS DOUBLE))) ELSE TRY_CAST(max AS DOUBLE) END AS hi
  FROM sp WHERE type <> 'categorical'
  UNION ALL
  SELECT experiment, CAST(off + generate_subscripts(list, 1) - 1 AS INTEGER), 0.0, 1.0 FROM sp WHERE type = 'categorical') b
USING (experiment, dim)""", "param_specs", "objective_values", "assignments", "experiments", extra=ENC_SQL))
def q_scale(spark, d):
    e = _encoded(spark, d)
    r = space.min_max_scale(e, space.space_bounds(_specs(spark, d)))
    return r.withColumn("scaled", F.round("scaled", 9))


# ------------------------------------------------------------- matching

KEY_SQL = ("keyed", """SELECT a.experiment, a.trial, t.pos, t.state,
    array_to_string(list_transform(list_sort(a.assignments), lambda x: x.name || ':' || x.value), ',') AS key
  FROM assignments a JOIN trials_state t USING (trial)""")


def _keyed(spark, d):
    c = Ctx(spark, d)
    a = views.assignments(spark, d)
    return a.join(c.trials_state.select("trial", "pos", "state"), "trial").select(
        "experiment", "trial", "pos", "state", space.assignment_key(F.col("assignments")).alias("key"))


@register("o52_assignment_fifo_match", with_views("""
SELECT f.experiment, f.trial, s.trial AS suggestion
FROM (SELECT *, row_number() OVER (PARTITION BY experiment, key ORDER BY pos) AS rn FROM keyed
      WHERE state IN ('Succeeded', 'EarlyStopped')) f
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY experiment, key ORDER BY pos) AS rn FROM keyed) s
  ON s.experiment = f.experiment AND s.key = f.key AND s.rn = f.rn""", "assignments", "trials_state", extra=[KEY_SQL]))
def q_fifo(spark, d):
    k = _keyed(spark, d)
    sug = k.select("experiment", F.col("trial").alias("id"), F.col("pos").alias("order"), "key")
    fin = k.filter(F.col("state").isin("Succeeded", "EarlyStopped")).select("experiment", "trial", F.col("pos").alias("order"), "key")
    return space.fifo_match(sug, fin)


@register("o52b_assignment_key", with_views("SELECT experiment, trial, key FROM keyed", "assignments", "trials_state",
                                            extra=[KEY_SQL]))
def q_key(spark, d):
    return _keyed(spark, d).select("experiment", "trial", "key")


@register("o53_newest_running_match", with_views("""
SELECT f.experiment, f.trial, s.trial AS suggestion
FROM (SELECT *, row_number() OVER (PARTITION BY experiment, key ORDER BY pos) AS rn FROM keyed WHERE state = 'Succeeded') f
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY experiment, key ORDER BY pos DESC) AS rn FROM keyed
           WHERE state = 'Running') s
  ON s.experiment = f.experiment AND s.key = f.key AND s.rn = f.rn""", "assignments", "trials_state", extra=[KEY_SQL]))
def q_newest(spark, d):
    k = _keyed(spark, d)
    sug = k.select("experiment", F.col("trial").alias("id"), F.col("pos").alias("order"), "key",
                   (F.col("state") == "Running").alias("running"))
    fin = k.filter(F.col("state") == "Succeeded").select("experiment", "trial", F.col("pos").alias("order"), "key")
    return space.newest_running_match(sug, fin)


# ------------------------------------------------------------- template

def _template_sql() -> str:
    t = views.TEMPLATE.replace("'", "''").replace("\n", "\\n")
    return f"""
SELECT experiment, trial, CASE WHEN err IS NULL THEN list_reduce(resolved, lambda acc, r: replace(acc,
         '${{trialParameters.' || r.name || '}}', r.value), E'{t}') END AS rendered, err AS error
FROM (SELECT *, CASE WHEN len(list_filter(resolved, lambda r: r.value IS NULL)) > 0
          THEN 'unresolved reference: ' || list_filter(resolved, lambda r: r.value IS NULL)[1].reference
        WHEN len(assignments) <> len(list_filter(resolved, lambda r: r.plain))
          THEN 'assignment count ' || len(assignments) || ' != trial parameter count ' || len(list_filter(resolved, lambda r: r.plain))
        END AS err
  FROM (SELECT a.experiment, a.trial, a.assignments, list_transform(tp, lambda p: {{
            'name': p.name,
            'value': CASE WHEN CASE WHEN starts_with(p.reference, '${{trialSpec.') THEN rtrim(p.reference[13:], '}}') ELSE '' END = ''
                            THEN list_filter(a.assignments, lambda x: x.name = p.reference)[1].value
                          WHEN CASE WHEN starts_with(p.reference, '${{trialSpec.') THEN rtrim(p.reference[13:], '}}') ELSE '' END = 'Name' THEN a.trial
                          WHEN CASE WHEN starts_with(p.reference, '${{trialSpec.') THEN rtrim(p.reference[13:], '}}') ELSE '' END = 'Namespace' THEN 'ns-' || (c.c_nationkey % 3)
                          WHEN CASE WHEN starts_with(p.reference, '${{trialSpec.') THEN rtrim(p.reference[13:], '}}') ELSE '' END = 'Kind' THEN 'Job'
                          WHEN CASE WHEN starts_with(p.reference, '${{trialSpec.') THEN rtrim(p.reference[13:], '}}') ELSE '' END = 'APIVersion' THEN 'batch/v1'
                          WHEN CASE WHEN starts_with(p.reference, '${{trialSpec.') THEN rtrim(p.reference[13:], '}}') ELSE '' END = 'Labels[team]'
                            THEN 'team-' || (c.c_custkey % 4) END,
            'plain': CASE WHEN starts_with(p.reference, '${{trialSpec.') THEN rtrim(p.reference[13:], '}}') ELSE '' END = '',
            'reference': p.reference}}) AS resolved
        FROM assignments a JOIN customer c ON a.trial = 'trial-' || c.c_custkey JOIN tmpl t USING (experiment)))"""


@register("o54_template_substitution", with_views(_template_sql(), "assignments", extra=[
    ("tmpl", """SELECT 'exp-' || n_nationkey AS experiment, list_filter([
        {'name': 'learningRate', 'reference': 'lr'}, {'name': 'numEstimators', 'reference': 'ne'},
        {'name': 'booster', 'reference': 'booster'},
        CASE WHEN n_nationkey % 7 <> 3 THEN {'name': 'depth', 'reference': 'depth'} END,
        {'name': 'trialName', 'reference': '${trialSpec.Name}'}, {'name': 'trialNs', 'reference': '${trialSpec.Namespace}'},
        {'name': 'kind', 'reference': '${trialSpec.Kind}'},
        {'name': 'team', 'reference': CASE WHEN n_nationkey % 9 = 4 THEN '${trialSpec.Labels[owner]}'
                                           ELSE '${trialSpec.Labels[team]}' END},
        CASE WHEN n_nationkey % 5 = 0 THEN {'name': 'momentum', 'reference': 'momentum'} END], lambda x: x IS NOT NULL) AS tp
      FROM nation""")]))
def q_template(spark, d):
    return space.substitute_template(views.trial_meta(spark, d), views.templates(spark, d))
