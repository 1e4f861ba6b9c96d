"""Search guidance as set operations (O56a–O56h).

Hyperband schedules, rung promotion, PBT generations, TPE-style candidate
scoring and early-stopping rules are computed for every experiment in one
plan.  Per-group "first k" selections use the salted two-phase top-k from
``state.top_k_per_group``; random choices are md5 draws.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trialfold.functions.exprs import md5_uniform, num, small, time_key
from trialfold.functions.select import quantiles, ranked_in_groups
from trialfold.operators.state import top_k_per_group
from trialfold.session import cut_lineage


def hyperband_schedule(experiments: DataFrame) -> DataFrame:
    """s_max = int(ln R / ln eta); bracket s: n = ceil((s_max+1) *
    eta^s / (s+1)), r = R * eta^-s; rung i: n_i = ceil(n * eta^-i), keep
    ceil(n_i / eta), r_i = int(r * eta^i).
    Output (experiment, s, i, n, r, n_i, keep, r_i)."""
    e = experiments.select("experiment", F.col("hb_eta").cast("double").alias("eta"), F.col("hb_r").cast("double").alias("R"))
    e = e.withColumn("s_max", F.floor(F.log(F.col("R")) / F.log(F.col("eta"))).cast("int"))
    b = e.select("*", F.explode(F.sequence(F.col("s_max"), F.lit(0), F.lit(-1))).alias("s"))
    b = b.withColumn("n", F.ceil((F.col("s_max") + 1).cast("double") * (F.pow("eta", F.col("s")) / (F.col("s") + 1).cast("double"))).cast("long"))
    b = b.withColumn("r", F.col("R") * F.pow("eta", -F.col("s")))
    r = b.select("*", F.explode(F.sequence(F.lit(0), F.col("s"))).alias("i"))
    n_i = F.ceil(F.col("n") * F.pow("eta", -F.col("i"))).cast("long")
    return r.select("experiment", F.col("s").cast("int").alias("s"), F.col("i").cast("int").alias("i"), "n",
                    F.round("r", 9).alias("r"), n_i.alias("n_i"),
                    F.ceil(n_i / F.col("eta")).cast("long").alias("keep"),
                    F.floor(F.col("r") * F.pow("eta", F.col("i"))).cast("long").alias("r_i"))


def rung_promotion(objective: DataFrame, trials: DataFrame, assignments: DataFrame, experiments: DataFrame,
                   requests: DataFrame, resource: str = "ne") -> DataFrame:
    """The last m trials by start time must all be Succeeded (else one
    error row); the best k by objective (direction-aware, stable: earlier
    start first on ties) are copied with the resource parameter set to r.
    ``requests`` (experiment, m, k, r).  Output (experiment, rank, trial,
    assignments text, error)."""
    t = trials.select("experiment", "trial", "created", "pos").join(requests, "experiment")
    last = top_k_per_group(t, ["experiment"], [F.col("created").desc(), F.col("pos").desc()], F.col("m"),
                           salt_key=[F.col("trial")])
    o = objective.select("trial", "state", "value")
    last = last.join(o, "trial").join(small(experiments.select("experiment", "objective_type")), "experiment")
    # at most m rows per experiment, read twice below: materialise once
    last = cut_lineage(last)
    chk = last.groupBy("experiment").agg(
        F.bool_and((F.col("state") == "Succeeded") & num("value").isNotNull()).alias("ok"))
    good = last.join(chk.filter("ok"), "experiment", "left_semi")
    key = F.when(F.col("objective_type") == "maximize", -num("value")).otherwise(num("value"))
    w = Window.partitionBy("experiment").orderBy(key, F.col("created").asc(), F.col("pos").asc())
    top = good.withColumn("prank", F.row_number().over(w)).filter(F.col("prank") <= F.col("k"))
    a = top.join(assignments.select("trial", "assignments"), "trial")
    txt = F.array_join(F.transform("assignments", lambda x: F.concat(
        x["name"], F.lit("="), F.when(x["name"] == resource, F.col("r").cast("string")).otherwise(x["value"]))), ",")
    ok_rows = a.select("experiment", F.col("prank").cast("int").alias("rank"), "trial", txt.alias("assignments"),
                       F.lit(None).cast("string").alias("error"))
    bad = chk.filter(~F.col("ok")).select("experiment", F.lit(None).cast("int").alias("rank"), F.lit(None).cast("string").alias("trial"),
                                          F.lit(None).cast("string").alias("assignments"),
                                          F.lit("trials of the rung are not all completed").alias("error"))
    return ok_rows.unionByName(bad)


def pbt_split(pool: DataFrame, experiments: DataFrame, seed: int = 0) -> DataFrame:
    """Per experiment the linear quantiles at tau and 1-tau of the
    pool's metric (already direction-scaled); below low -> exploit, else
    explore, >= high -> upper.  After an md5 shuffle exploit keeps
    int(count*tau) and explore count - len(exploit).
    ``pool`` (experiment, trial, metric_value, count).
    Output (experiment, trial, metric_value, low, high, role, upper, kept)."""
    e = small(experiments.select("experiment", F.col("pbt_tau").alias("tau")))
    # the pool (one row per finished population member) is read several
    # times: materialise it once
    p = cut_lineage(pool.join(e, "experiment"))
    low, high = _quantiles(p)
    p = p.join(small(low), "experiment").join(small(high), "experiment")
    role = F.when(F.col("metric_value") < F.col("low"), F.lit("exploit")).otherwise(F.lit("explore"))
    upper = (role == "explore") & (F.col("metric_value") >= F.col("high"))
    p = p.withColumn("role", role).withColumn("upper", upper)
    p = p.withColumn("shuffle", md5_uniform(F.lit(seed), F.lit("pbt"), F.col("trial")))
    p = ranked_in_groups(cut_lineage(p), ["experiment", "role"], [F.col("shuffle"), F.col("trial")], "rn")
    n_exploit = p.filter(F.col("role") == "exploit").groupBy("experiment").agg(F.count("*").alias("n_exploit"))
    p = p.join(n_exploit, "experiment", "left")
    cap_exploit = F.floor(F.col("count") * F.col("tau")).cast("long")
    kept_exploit = F.least(F.coalesce(F.col("n_exploit"), F.lit(0)), cap_exploit)
    kept = F.when(F.col("role") == "exploit", F.col("rn") <= cap_exploit).otherwise(
        F.col("rn") <= F.col("count") - kept_exploit)
    return p.select("experiment", "trial", "metric_value", F.round("low", 9).alias("low"), F.round("high", 9).alias("high"),
                    "role", "upper", kept.alias("kept"))


def _quantiles(p: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Exact linear quantiles at tau and 1 - tau per experiment."""
    tau = p.select("experiment", "tau").distinct()
    both = tau.select("experiment", F.explode(F.array("tau", 1 - F.col("tau"))).alias("fraction")).distinct()
    found = cut_lineage(quantiles(p, ["experiment"], "metric_value", both).join(tau, "experiment"))
    return (found.where("fraction = tau").select("experiment", F.col("quantile").alias("low")),
            found.where(F.col("fraction") == 1 - F.col("tau")).select("experiment", F.col("quantile").alias("high")))


def pbt_next_generation(split: DataFrame, assign_long: DataFrame, specs: DataFrame, experiments: DataFrame,
                        generation: DataFrame, seed: int = 0) -> DataFrame:
    """O56d: kept exploit trials copy the parameters of an md5-picked upper
    trial; kept explore trials perturb each parameter (int/double x0.8 or
    x1.2 clamped to [min, max]; list types one step left/right, -1 wraps to
    the last, past the end to the first) or, when a resample probability is
    set, resample it with that probability.  Generation + 1, parent = the
    replaced trial.  Output (experiment, parent, kind, generation, name,
    value_num, value_text)."""
    split = cut_lineage(split)  # read four times below; one row per pool member
    kept = split.filter("kept")
    up = split.filter("upper").select("experiment", F.col("trial").alias("up_trial"),
                                      F.row_number().over(Window.partitionBy("experiment").orderBy("trial")).alias("up_idx"))
    n_up = up.groupBy("experiment").agg(F.count("*").alias("n_up"))
    ex = kept.filter(F.col("role") == "exploit").join(n_up, "experiment")
    ex = ex.withColumn("up_idx", (F.floor(md5_uniform(F.lit(seed), F.lit("upper"), F.col("trial")) * F.col("n_up")) + 1).cast("int"))
    ex = ex.join(up, ["experiment", "up_idx"]).join(assign_long.withColumnRenamed("trial", "up_trial"), "up_trial")
    ex = ex.join(specs.select("experiment", "name", "type"), ["experiment", "name"])
    exploit_rows = ex.select("experiment", F.col("trial").alias("parent"), F.lit("exploit").alias("kind"), "name",
                             F.when(F.col("type").isin("int", "double"), F.col("value").try_cast("double")).alias("value_num"),
                             F.when(~F.col("type").isin("int", "double"), F.col("value")).alias("value_text"))
    xp = kept.filter(F.col("role") == "explore").join(assign_long, "trial")
    xp = xp.join(specs.select("experiment", "name", "type", "min", "max", "step", "list"), ["experiment", "name"])
    xp = xp.join(small(experiments.select("experiment", "pbt_resample_p")), "experiment")
    u = md5_uniform(F.lit(seed), F.lit("perturb"), F.col("trial"), F.col("name"))
    u2 = md5_uniform(F.lit(seed), F.lit("resample"), F.col("trial"), F.col("name"))
    u3 = md5_uniform(F.lit(seed), F.lit("pick"), F.col("trial"), F.col("name"))
    lo, hi = F.col("min").try_cast("double"), F.col("max").try_cast("double")
    st = F.col("step").try_cast("double")
    t = F.col("type")
    factor = F.when(u < 0.5, F.lit(0.8)).otherwise(F.lit(1.2))
    v = F.col("value").try_cast("double")
    pert_num = F.greatest(lo, F.least(hi, F.when(t == "int", F.floor(F.floor(v) * factor)).otherwise(v * factor)))
    lst = F.col("list")
    n = F.size(lst)
    idx0 = F.array_position(lst, F.col("value")) - 1 + F.when(u < 0.5, F.lit(-1)).otherwise(F.lit(1))
    pert_txt = F.element_at(lst, (F.when(idx0 >= n, F.lit(0)).when(idx0 < 0, n + idx0).otherwise(idx0) + 1).cast("int"))
    # resample: numeric sample list = arange(min, max + step/2, step)
    n_num = F.ceil((hi + st / 2 - lo) / st)
    samp_num = lo + F.floor(u3 * n_num) * st
    samp_txt = F.element_at(lst, (F.floor(u3 * n) + 1).cast("int"))
    p = F.col("pbt_resample_p")
    resample = p.isNotNull() & (u2 < p)
    keep = p.isNotNull() & ~(u2 < p)
    is_num = t.isin("int", "double")
    val_num = F.when(is_num, F.when(resample, samp_num).when(keep, v).otherwise(pert_num))
    val_txt = F.when(~is_num, F.when(resample, samp_txt).when(keep, F.col("value")).otherwise(pert_txt))
    explore_rows = xp.select("experiment", F.col("trial").alias("parent"), F.lit("explore").alias("kind"), "name",
                             val_num.alias("value_num"), val_txt.alias("value_text"))
    out = exploit_rows.unionByName(explore_rows).join(generation.select(F.col("trial").alias("parent"), "generation"), "parent")
    return out.select("experiment", "parent", "kind", (F.col("generation") + 1).alias("generation"), "name",
                      F.round("value_num", 9).alias("value_num"), "value_text")


def pbt_requeue(trials_state: DataFrame, population: DataFrame) -> DataFrame:
    """O56e: killed or failed trials are re-emitted with their parent and
    generation (and leave the sample pool).  Output (experiment, trial,
    parent, generation)."""
    bad = trials_state.filter(F.col("state").isin("Killed", "Failed")).select("experiment", "trial")
    return bad.join(population, "trial").select("experiment", "trial", "parent", "generation")


def lineage_roots(population: DataFrame, checkpoint=cut_lineage) -> DataFrame:
    """O56e lineage: root ancestor and depth of every trial by pointer
    jumping (each round doubles the jump), so depth d needs log2(d) joins
    instead of d.  Rounds go on until no pointer moves, whatever the depth;
    a chain that runs in a circle never ends and is an error.
    ``checkpoint`` cuts the plan after each round.
    Output (trial, root, depth)."""
    cur = population.select("trial", F.col("parent").alias("anc"),
                            F.when(F.col("parent").isNull(), F.lit(0)).otherwise(F.lit(1)).alias("depth"))
    for _ in range(64):
        nxt = cur.select(F.col("trial").alias("anc"), F.col("anc").alias("anc2"), F.col("depth").alias("d2"))
        cur = checkpoint(cur.join(nxt, "anc", "left")
                         .select("trial", F.coalesce("anc2", "anc").alias("anc"),
                                 (F.col("depth") + F.coalesce(F.col("d2"), F.lit(0))).alias("depth"),
                                 F.col("anc2").isNotNull().alias("moved")))
        if cur.filter("moved").isEmpty():
            return cur.select("trial", F.coalesce("anc", "trial").alias("root"), "depth")
        cur = cur.drop("moved")
    raise ValueError("the lineage runs in a circle")


def tpe_scores(candidates: DataFrame, trials: DataFrame, gamma: float = 0.25, bins: int = 20,
               prior_weight: float = 1.0, top: int = 1) -> DataFrame:
    """O56f (re-aimed): TPE-style scoring with histogram Parzen estimators.
    Trials split good/bad at the gamma quantile of the direction-scaled
    objective; per (experiment, dim, bin) smoothed densities l and g;
    a candidate's score is the sum over dims of ln(l/g) at its bins — an
    equi join on (experiment, dim, bin), never candidate x trial pairs.
    ``candidates`` and ``trials``: (experiment, id, dim, x in [0,1]) with
    ``trials`` also carrying ``y`` (higher is better).
    Output (experiment, candidate, score, rank) for the best ``top``."""
    ty = cut_lineage(trials.select("experiment", "id", "y").distinct())
    at = ty.select("experiment", F.lit(1.0 - gamma).alias("fraction")).distinct()
    thr = small(quantiles(ty, ["experiment"], "y", at).select("experiment", F.col("quantile").alias("thr")))
    lab = ty.join(thr, "experiment").select("experiment", "id", (F.col("y") >= F.col("thr")).alias("good"))
    ng = lab.groupBy("experiment").agg(F.count_if("good").alias("n_good"), F.count_if(~F.col("good")).alias("n_bad"))

    def binned(c):
        return F.least(F.floor(c * bins), F.lit(bins - 1)).cast("int")

    tb = trials.join(lab, ["experiment", "id"]).select("experiment", "dim", binned(F.col("x")).alias("bin"), "good")
    h = tb.groupBy("experiment", "dim", "bin").agg(F.count_if("good").alias("cg"), F.count_if(~F.col("good")).alias("cb"))
    cb = candidates.select("experiment", F.col("id").alias("candidate"), "dim", binned(F.col("x")).alias("bin"))
    j = cb.join(h, ["experiment", "dim", "bin"], "left").join(ng, "experiment")
    pw = F.lit(prior_weight)
    l = (F.coalesce("cg", F.lit(0)) + pw / bins) / (F.col("n_good") + pw)
    g = (F.coalesce("cb", F.lit(0)) + pw / bins) / (F.col("n_bad") + pw)
    s = j.groupBy("experiment", "candidate").agg(F.sum(F.log(l) - F.log(g)).alias("score"))
    w = Window.partitionBy("experiment").orderBy(F.col("score").desc(), "candidate")
    return s.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top).select(
        "experiment", "candidate", F.round("score", 9).alias("score"), F.col("rank").cast("int").alias("rank"))


def median_stop_rule(obs: DataFrame, trials_state: DataFrame, experiments: DataFrame) -> DataFrame:
    """O56g: per Succeeded trial the average of its first ``start_step``
    objective values by time; with at least ``min_trials`` trials the rule
    value is the mean of those averages (Q6); comparison 'less' for
    maximize, 'greater' for minimize.  Output (experiment, n_trials,
    rule_value, comparison)."""
    e = small(experiments.select("experiment", "objective_metric", "objective_type", "ms_start_step", "ms_min_trials"))
    t = trials_state.filter(F.col("state") == "Succeeded").select("trial", "experiment").join(e, "experiment")
    o = obs.join(t, "trial").filter(F.col("metric") == F.col("objective_metric"))
    o = o.withColumn("x", num("value")).filter(F.col("x").isNotNull()).withColumn("tk", time_key(F.col("ts")))
    first = top_k_per_group(o.select("experiment", "trial", "tk", "seq", "x", "ms_start_step"), ["trial"],
                            [F.col("tk"), F.col("seq")], F.col("ms_start_step"), salt_key=[F.col("seq")])
    avg = first.groupBy("experiment", "trial").agg(F.avg("x").alias("avg"))
    g = avg.groupBy("experiment").agg(F.count("*").alias("n_trials"), F.avg("avg").alias("mean_of_averages"))
    g = g.join(e, "experiment")
    cmp = F.when(F.col("objective_type") == "maximize", F.lit("less")).otherwise(F.lit("greater"))
    return g.select("experiment", "n_trials",
                    F.when(F.col("n_trials") >= F.col("ms_min_trials"), F.round("mean_of_averages", 9)).alias("rule_value"),
                    cmp.alias("comparison"))


def evaluate_stop_rules(obs: DataFrame, trials: DataFrame, rules: DataFrame, salts: int = 16) -> DataFrame:
    """O56h: a trial stops when every rule of its experiment is met.  A
    rule (metric, value, comparison, start_step) is met by the first log
    row of its metric, from the start_step-th on, whose value compares
    true.  Output (trial, stopped, stop_seq) — the row at which the last
    rule became true."""
    r = small(rules)
    t = trials.select("trial", "experiment")
    o = obs.join(t, "trial").join(r, ["experiment", "metric"])
    o = o.withColumn("x", num("value")).withColumn("tk", time_key(F.col("ts")))
    rv = F.col("rule_value").try_cast("double")
    hit = (F.when(F.col("comparison") == "equal", F.col("x") == rv)
           .when(F.col("comparison") == "less", F.col("x") < rv)
           .when(F.col("comparison") == "greater", F.col("x") > rv))
    o = o.select("trial", "rule", F.greatest("start_step", F.lit(1)).alias("start_step"), "tk", "seq", F.coalesce(hit, F.lit(False)).cast("int").alias("hit"))
    # fewer than start_step hits stand before the start_step-th row, so the
    # answer is among the first start_step rows and the first start_step hits
    salt = F.pmod(F.xxhash64("seq"), F.lit(salts))
    o = o.withColumn("_salt", salt).repartition("trial", "rule", "_salt")
    for keys in (["trial", "rule", "_salt"], ["trial", "rule"]):
        w = Window.partitionBy(*keys).orderBy("tk", "seq")
        so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        o = (o.withColumn("rn", F.row_number().over(w)).withColumn("hits", F.sum("hit").over(so_far))
             .filter((F.col("rn") <= F.col("start_step")) | ((F.col("hit") == 1) & (F.col("hits") <= F.col("start_step")))))
    # the first start_step rows are all kept, so ranks up to it are exact
    met = o.filter((F.col("hit") == 1) & (F.col("rn") >= F.col("start_step"))).groupBy("trial", "rule").agg(
        F.min(F.struct("tk", "seq")).alias("first"))
    n_rules = r.groupBy("experiment").agg(F.count("*").alias("n_rules"))
    per = met.join(t, "trial").groupBy("trial", "experiment").agg(F.count("*").alias("n_met"), F.max("first").alias("last"))
    res = t.join(per, ["trial", "experiment"], "left").join(n_rules, "experiment")
    stopped = F.coalesce(F.col("n_met"), F.lit(0)) == F.col("n_rules")
    return res.select("trial", stopped.alias("stopped"), F.when(stopped, F.col("last")["seq"]).alias("stop_seq"))
