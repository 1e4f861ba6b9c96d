"""Canonical DataFrames derived from the driver's tables.

The reference's record kinds (metric-log rows, trials, experiments,
parameter specs, ...) are mapped onto the given parquet tables so that
every registered query reads them and its work grows with them.  The
DuckDB twins of these definitions live in ``plans/oracle.py``; keep the two
in step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trialfold.functions.exprs import estimated_bytes

# Fixed values of this mapping (segment -> declared trial state).
SEGMENT_STATE = [
    ("BUILDING", "Succeeded"),
    ("AUTOMOBILE", "EarlyStopped"),
    ("MACHINERY", "Failed"),
    ("FURNITURE", "Running"),
    ("HOUSEHOLD", "MetricsUnavailable"),
]
# Algorithm name by nation key % 8.
ALGORITHMS = ["random", "grid", "hyperband", "tpe", "bayesianoptimization", "cmaes", "pbt", "enas"]
BOOSTERS = ["gbtree", "dart", "gblinear"]
EPOCH_2024 = 1704067200


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Tasks of a log view at most, so that their shuffle blocks stay countable.
MOST_TASKS = 4096
#: Table bytes (as stored) that one task of a log view parses; about 150,000 events.
SPREAD_BYTES = 2 << 20


def _spread(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Log views stand for many log files.  The table is dealt to tasks by its
    size before per-line parsing, at least one for each core: a file's splits
    may outnumber its row groups, and a task that parses a whole row group or a
    fixed share of the table would grow with it."""
    cores = max(spark.sparkContext.defaultParallelism, 1)
    return df.repartition(max(cores, min(estimated_bytes(df) // SPREAD_BYTES + 1, MOST_TASKS)))


def _pick(key: Column, values: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (key % len(values) + 1).cast("int"))


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric-log rows: (trial, seq, ts, metric, value)."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.concat(F.lit("trial-"), F.col("user_id").cast("string")).alias("trial"),
        F.col("event_id").alias("seq"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_type").alias("metric"),
        F.col("value").cast("string").alias("value"),
    )


def trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    seg = F.col("c_mktsegment")
    state = F.lit("Pending")
    for s, st in SEGMENT_STATE:
        state = F.when(seg == s, F.lit(st)).otherwise(state)
    k = F.col("c_custkey")
    running = seg == "FURNITURE"
    pending = running & (k % 5 == 0)

    def cond(t, s):
        t = F.lit(t) if isinstance(t, str) else t
        return F.struct(t.alias("type"), s.alias("status"))

    conds = F.array(
        cond("Created", F.lit("True")),
        F.when(~pending, cond("Running", F.when(running, F.lit("True")).otherwise(F.lit("False")))),
        F.when(~running, cond(state, F.lit("True"))),
        F.when((seg == "MACHINERY") & (k % 7 == 0), cond("Killed", F.lit("True"))),
    )
    return c.select(
        F.concat(F.lit("trial-"), k.cast("string")).alias("trial"),
        F.concat(F.lit("exp-"), F.col("c_nationkey").cast("string")).alias("experiment"),
        F.concat(F.lit("ns-"), (F.col("c_nationkey") % 3).cast("string")).alias("namespace"),
        k.alias("pos"),
        F.timestamp_seconds(F.lit(EPOCH_2024) + k * 60).alias("created"),
        F.when(pending, F.lit("Pending")).otherwise(state).alias("declared_state"),
        F.filter(conds, lambda x: x.isNotNull()).alias("conditions"),
    )


def experiments(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    odd = k % 2 == 1
    strat = F.struct(F.lit("").alias("name"), F.lit("").alias("value"))
    empty = F.filter(F.array(strat), lambda x: F.lit(False))
    return n.select(
        F.concat(F.lit("exp-"), k.cast("string")).alias("experiment"),
        F.concat(F.lit("ns-"), (k % 3).cast("string")).alias("namespace"),
        F.lit("purchase").alias("objective_metric"),
        F.when(odd, F.lit("minimize")).otherwise(F.lit("maximize")).alias("objective_type"),
        F.when(k % 5 == 0, F.lit(None).cast("double"))
         .when(odd, F.lit(0.05)).otherwise(F.lit(480.0)).alias("goal"),
        F.when(odd, F.array(F.lit("error"))).otherwise(F.array(F.lit("view"), F.lit("click"))).alias("additional_metrics"),
        F.when(k % 4 == 0, F.array(F.struct(F.lit("purchase").alias("name"), F.lit("latest").alias("value"))))
         .when(k % 4 == 1, F.array(F.struct(F.lit("error").alias("name"), F.lit("max").alias("value"))))
         .otherwise(empty).alias("metric_strategies"),
        (F.lit(20) + k * 3).cast("int").alias("max_trial_count"),
        (F.lit(3) + k % 5).cast("int").alias("parallel_trial_count"),
        F.when(k % 4 == 3, F.lit(None).cast("int")).otherwise(F.lit(5) + k).cast("int").alias("max_failed_trial_count"),
        _pick(k, ["Never", "LongRunning", "FromVolume"]).alias("resume_policy"),
        _pick(k, ALGORITHMS).alias("algorithm"),
        (k % 6 == 5).alias("suggestions_ended"),
        # algorithm settings used by the guidance operators (O56a-h)
        F.when(k % 4 == 1, F.lit(2)).otherwise(F.lit(3)).alias("hb_eta"),
        (F.lit(9) * (F.lit(1) + k % 3)).cast("int").alias("hb_r"),
        F.when(k % 3 == 0, F.lit(0.2)).when(k % 3 == 1, F.lit(0.3)).otherwise(F.lit(0.4)).alias("pbt_tau"),
        F.when(k % 2 == 1, F.lit(0.3)).otherwise(F.lit(None).cast("double")).alias("pbt_resample_p"),
        (F.lit(2) + k % 3).cast("int").alias("ms_start_step"),
        F.lit(3).alias("ms_min_trials"),
        F.lit(0.25).alias("tpe_gamma"),
    )


def assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parameter assignments of every trial, in spec order (lr, ne, booster, depth)."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    lr = F.concat(F.lit("0."), F.lpad(((k % 97) + 1).cast("string"), 3, "0"))
    ne = (F.lit(50) + (k % 10) * 50).cast("string")
    booster = _pick(F.col("c_nationkey"), BOOSTERS)

    def a(name, v):
        return F.struct(F.lit(name).alias("name"), v.alias("value"))

    depth = _pick(k, ["3", "5", "8"])
    return c.select(
        F.concat(F.lit("trial-"), k.cast("string")).alias("trial"),
        F.concat(F.lit("exp-"), F.col("c_nationkey").cast("string")).alias("experiment"),
        F.array(a("lr", lr), a("ne", ne), a("booster", booster), a("depth", depth)).alias("assignments"),
    )


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text training logs: one printed line per event, (trial, experiment,
    line_no, line).  Every 50th line has a broken time, every 70th no '='.
    The experiment plays the role of the log file's directory."""
    e = _spread(spark, table(spark, sf_dir, "events"))
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    eid = F.col("event_id")
    good = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    bad = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    stamp = F.when(eid % 50 == 0, bad).otherwise(good)
    sep = F.when(eid % 70 == 0, F.lit(" ")).otherwise(F.lit("="))
    line = F.concat(stamp, F.lit("Z INFO "), F.col("event_type"), sep, F.col("value").cast("string"))
    return (e.join(c, e.user_id == c.c_custkey, "inner")
             .select(F.concat(F.lit("trial-"), F.col("user_id").cast("string")).alias("trial"),
                     F.concat(F.lit("exp-"), F.col("c_nationkey").cast("string")).alias("experiment"),
                     eid.alias("line_no"), line.alias("line")))


def json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON-lines training logs (trial, experiment, line_no, line): epoch
    time every 3rd line, no time every 13th, a numeric (ignored) value every
    11th, a truncated object every 97th."""
    e = _spread(spark, table(spark, sf_dir, "events"))
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    eid = F.col("event_id")
    ts = F.col("ts").cast("timestamp")
    epoch = F.concat(F.unix_seconds(ts).cast("string"), F.lit("."),
                     F.lpad((F.unix_micros(ts) % 1000000).cast("string"), 6, "0"))
    iso = F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    tspart = (F.when(eid % 13 == 0, F.lit(""))
              .when(eid % 3 == 0, F.concat(F.lit('"timestamp": '), epoch, F.lit(", ")))
              .otherwise(F.concat(F.lit('"timestamp": "'), iso, F.lit('", '))))
    v = F.col("value").cast("string")
    valpart = F.when(eid % 11 == 0, v).otherwise(F.concat(F.lit('"'), v, F.lit('"')))
    line = F.when(eid % 97 == 0, F.lit('{"timestamp": ')).otherwise(
        F.concat(F.lit("{"), tspart, F.lit('"'), F.col("event_type"), F.lit('": '), valpart, F.lit("}")))
    return (e.join(c, e.user_id == c.c_custkey, "inner")
             .select(F.concat(F.lit("trial-"), F.col("user_id").cast("string")).alias("trial"),
                     F.concat(F.lit("exp-"), F.col("c_nationkey").cast("string")).alias("experiment"),
                     eid.alias("line_no"), line.alias("line")))


# TF-event style metric names (folder/leaf) watched for every trial.
TF_METRICS = ["train/purchase", "eval/click", "view", "misc/error"]


def scalar_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded scalar events (trial, path, tag, wall_time, value)."""
    e = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    folder = _pick(eid, ["train", "eval", "misc"])
    trial = F.concat(F.lit("trial-"), F.col("user_id").cast("string"))
    return e.select(trial.alias("trial"),
                    F.concat(F.lit("/logs/"), trial, F.lit("/"), folder, F.lit("/events.out")).alias("path"),
                    F.concat(F.col("event_type"), F.when(eid % 2 == 0, F.lit("_v1")).otherwise(F.lit(""))).alias("tag"),
                    F.col("ts").cast("timestamp").alias("wall_time"), F.col("value"))


def tf_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(trial, metric) watch list: every trial x TF_METRICS."""
    t = table(spark, sf_dir, "customer").select(F.concat(F.lit("trial-"), F.col("c_custkey").cast("string")).alias("trial"))
    return t.select("trial", F.explode(F.array(*[F.lit(m) for m in TF_METRICS])).alias("metric"))


def range_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One log-range request per trial: metric only for even keys, start
    2024-01-05 + key%5 days, end 2024-01-20 except every 3rd key."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    trial = F.concat(F.lit("trial-"), k.cast("string"))
    start = F.timestamp_seconds(F.lit(EPOCH_2024 + 4 * 86400) + (k % 5) * 86400)
    end = F.when(k % 3 == 0, F.lit(None).cast("timestamp")).otherwise(F.timestamp_seconds(F.lit(EPOCH_2024 + 19 * 86400)))
    return c.select(trial.alias("req"), trial.alias("trial"),
                    F.when(k % 2 == 0, F.lit("purchase")).alias("req_metric"), start.alias("start"), end.alias("end"))


def _spec(pos, name, typ, mn, mx, step, lst):
    return F.struct(F.lit(pos).alias("pos"), F.lit(name).alias("name"), F.lit(typ).alias("type"),
                    mn.alias("min"), mx.alias("max"), step.alias("step"), lst.alias("list"))


def _ns():
    return F.lit(None).cast("string")


def _nl():
    return F.lit(None).cast("array<string>")


def _arr(*v):
    return F.array(*[F.lit(x) for x in v])


def param_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search space of every experiment: lr (double), ne (int), booster
    (categorical), depth (discrete); bounds vary with the nation key."""
    n = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    arr = F.array(
        _spec(0, "lr", "double", F.lit("0.01"), F.concat(F.lit("0.0"), (F.lit(5) + k % 5).cast("string")), F.lit("0.01"), _nl()),
        _spec(1, "ne", "int", F.lit("50"), (F.lit(100) + (k % 4) * 50).cast("string"),
              F.when(k % 3 == 0, F.lit("25")).otherwise(F.lit("50")), _nl()),
        _spec(2, "booster", "categorical", _ns(), _ns(), _ns(), _arr(*BOOSTERS)),
        _spec(3, "depth", "discrete", _ns(), _ns(), _ns(),
              F.when(k % 2 == 1, _arr("3", "5", "8", "12")).otherwise(_arr("3", "5", "8"))),
    )
    return n.select(F.concat(F.lit("exp-"), k.cast("string")).alias("experiment"), F.explode(arr).alias("s")).select(
        "experiment", "s.*")


def _p(name, typ, mn=None, mx=None, step=None, lst=None):
    return F.struct(F.lit(name).alias("name"), F.lit(typ).alias("type"),
                    (mn if mn is not None else _ns()).alias("min"), (mx if mx is not None else _ns()).alias("max"),
                    (step if step is not None else _ns()).alias("step"), (lst if lst is not None else _nl()).alias("list"))


def nas_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NAS operation specs per experiment: (experiment, op_pos, op_type, params)."""
    n = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    fs = F.when(k % 2 == 1, _arr("3", "5", "7")).otherwise(_arr("3", "5"))
    nf = F.when(k % 3 == 0, _arr("32", "48", "64")).otherwise(_arr("32", "48"))
    ptype = "struct<name:string,type:string,min:string,max:string,step:string,list:array<string>>"
    ops = F.array(
        F.struct(F.lit(0).alias("op_pos"), F.lit("convolution").alias("op_type"),
                 F.array(_p("filter_size", "categorical", lst=fs), _p("num_filter", "categorical", lst=nf)).alias("params")),
        F.struct(F.lit(1).alias("op_pos"), F.lit("separable_convolution").alias("op_type"),
                 F.array(_p("filter_size", "categorical", lst=_arr("3", "5"))).alias("params")),
        F.struct(F.lit(2).alias("op_pos"), F.lit("reduction").alias("op_type"),
                 F.array(_p("reduction_type", "categorical", lst=_arr("max_pooling", "avg_pooling")),
                         _p("pool_size", "int", F.lit("2"), F.lit("3"), F.lit("1"))).alias("params")),
        F.struct(F.lit(3).alias("op_pos"), F.lit("skip_connection").alias("op_type"),
                 F.array().cast(f"array<{ptype}>").alias("params")),
    )
    return n.select(F.concat(F.lit("exp-"), k.cast("string")).alias("experiment"), F.explode(ops).alias("o")).select(
        "experiment", "o.*")


def _kv(name, value):
    return F.struct(F.lit(name).alias("name"), value.alias("value"))


def settings_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    arr = F.array(_kv("random_state", k.cast("string")), _kv("n_startup_trials", F.lit("10")), _kv("gamma", F.lit("0.25")))
    return n.select(F.concat(F.lit("exp-"), k.cast("string")).alias("experiment"), F.posexplode(arr).alias("pos", "s")).select(
        "experiment", F.col("pos").cast("int").alias("pos"), "s.name", "s.value")


def settings_over(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    arr = F.filter(F.array(F.when(k % 2 == 1, _kv("gamma", F.lit("0.1"))),
                           F.when(k % 3 == 0, _kv("prior_weight", F.lit("1.0")))), lambda x: x.isNotNull())
    return n.select(F.concat(F.lit("exp-"), k.cast("string")).alias("experiment"), F.posexplode(arr).alias("pos", "s")).select(
        "experiment", F.col("pos").cast("int").alias("pos"), "s.name", "s.value")


TEMPLATE = ("apiVersion: batch/v1\nkind: Job\nspec: train --lr=${trialParameters.learningRate} "
            "--ne=${trialParameters.numEstimators} --booster=${trialParameters.booster} "
            "--depth=${trialParameters.depth} --name=${trialParameters.trialName} "
            "--ns=${trialParameters.trialNs} --kind=${trialParameters.kind} --team=${trialParameters.team}")


def templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trial templates: fixed text; trial parameters vary with the key
    (an unknown assignment every 5th, a missing depth every 7th+3, an
    unknown label every 9th+4)."""
    n = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")

    def tp(name, ref):
        return F.struct(F.lit(name).alias("name"), (ref if not isinstance(ref, str) else F.lit(ref)).alias("reference"))

    params = F.array(
        tp("learningRate", "lr"), tp("numEstimators", "ne"), tp("booster", "booster"),
        F.when(k % 7 != 3, tp("depth", "depth")),
        tp("trialName", "${trialSpec.Name}"), tp("trialNs", "${trialSpec.Namespace}"), tp("kind", "${trialSpec.Kind}"),
        tp("team", F.when(k % 9 == 4, F.lit("${trialSpec.Labels[owner]}")).otherwise(F.lit("${trialSpec.Labels[team]}"))),
        F.when(k % 5 == 0, tp("momentum", "momentum")),
    )
    return n.select(F.concat(F.lit("exp-"), k.cast("string")).alias("experiment"), F.lit(TEMPLATE).alias("template"),
                    F.lit("Job").alias("kind"), F.lit("batch/v1").alias("api_version"),
                    F.filter(params, lambda x: x.isNotNull()).alias("trial_parameters"))


def trial_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(experiment, trial, namespace, assignments, labels, annotations)."""
    a = assignments(spark, sf_dir)
    c = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("trial-"), F.col("c_custkey").cast("string")).alias("trial"),
        F.concat(F.lit("ns-"), (F.col("c_nationkey") % 3).cast("string")).alias("namespace"),
        F.create_map(F.lit("team"), F.concat(F.lit("team-"), (F.col("c_custkey") % 4).cast("string"))).alias("labels"),
        F.create_map().cast("map<string,string>").alias("annotations"))
    return a.join(c, "trial")


def population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PBT lineage: generation = key // 500, parent = the trial 500 keys
    earlier (none in generation 0)."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    gen = F.floor(k / 500).cast("int")
    return c.select(F.concat(F.lit("trial-"), k.cast("string")).alias("trial"),
                    F.concat(F.lit("exp-"), F.col("c_nationkey").cast("string")).alias("experiment"),
                    gen.alias("generation"),
                    F.when(gen > 0, F.concat(F.lit("trial-"), (k - 500).cast("string"))).alias("parent"))


def stop_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Early-stopping rules per experiment: (experiment, rule, metric,
    rule_value, comparison, start_step)."""
    n = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    odd = k % 2 == 1
    r0 = F.struct(F.lit(0).alias("rule"), F.lit("purchase").alias("metric"),
                  F.when(odd, F.lit("50")).otherwise(F.lit("20")).alias("rule_value"),
                  F.when(odd, F.lit("greater")).otherwise(F.lit("less")).alias("comparison"),
                  (F.lit(2) + k % 3).cast("int").alias("start_step"))
    r1 = F.when(~odd, F.struct(F.lit(1).alias("rule"), F.lit("view").alias("metric"), F.lit("100").alias("rule_value"),
                               F.lit("less").alias("comparison"), F.lit(1).alias("start_step")))
    return n.select(F.concat(F.lit("exp-"), k.cast("string")).alias("experiment"),
                    F.explode(F.filter(F.array(r0, r1), lambda x: x.isNotNull())).alias("r")).select("experiment", "r.*")


def annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pipeline run id annotation of every 6th trial."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(F.concat(F.lit("trial-"), k.cast("string")).alias("trial"),
                    F.when(k % 6 == 0, F.concat(F.lit("run-"), (k % 50).cast("string"))).alias("kfp_run"))


def architectures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NAS architecture of every trial whose experiment runs a NAS
    algorithm: (experiment, trial, architecture JSON text)."""
    from trialfold.functions.exprs import small
    from trialfold.operators.report import NAS_ALGORITHMS, architecture_json
    c = table(spark, sf_dir, "customer")
    nas = experiments(spark, sf_dir).filter(F.col("algorithm").isin(NAS_ALGORITHMS)).select("experiment")
    c = c.withColumn("experiment", F.concat(F.lit("exp-"), F.col("c_nationkey").cast("string"))).join(
        small(nas), "experiment", "left_semi")
    return c.select(F.concat(F.lit("exp-"), F.col("c_nationkey").cast("string")).alias("experiment"),
                    F.concat(F.lit("trial-"), F.col("c_custkey").cast("string")).alias("trial"),
                    architecture_json(F.col("c_custkey")).alias("architecture"))


def dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tabular dataset (one row per order): text columns with the 'No Info'
    marker and NULLs injected by key, label learnable from two columns."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    k = F.col("o_orderkey")

    def marked(every_marker, every_null, value):
        return F.when(k % every_marker == 0, F.lit("No Info")).when(k % every_null == 0, F.lit(None).cast("string")).otherwise(value)

    hb = F.lit(4) + k % 5
    gl = F.lit(80) + (k * 7) % 220
    label = F.when((hb + gl / 100.0) >= 8.0, F.lit("1")).otherwise(F.lit("0"))
    gender = (F.when(k % 11 == 0, F.lit("Other")).when(k % 11 == 1, F.lit(None).cast("string"))
              .when(k % 11 == 2, F.lit("Unknown"))
              .otherwise(F.when(F.col("o_custkey") % 2 == 0, F.lit("Male")).otherwise(F.lit("Female"))))
    return o.select(
        k.alias("id"), gender.alias("gender"),
        marked(13, 17, (F.lit(18) + k % 60).cast("string")).alias("age"),
        marked(19, 23, F.concat((F.lit(15) + k % 25).cast("string"), F.lit("."), (k % 10).cast("string"))).alias("bmi"),
        marked(29, 31, F.concat(hb.cast("string"), F.lit("."), (k % 7).cast("string"))).alias("HbA1c_level"),
        marked(37, 41, gl.cast("string")).alias("blood_glucose_level"),
        marked(43, 47, label).alias("diabetes"))


def experiment_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Experiment specifications as submitted, with deliberate mistakes by
    nation key (bad name, zero max trials, oversized parallelism, negative
    failure budget, misspelt objective type, objective among additional
    metrics, missing algorithm, unknown resume policy, list on an int
    parameter, min on a categorical one, a duplicated parameter)."""
    n = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    exp = F.concat(F.lit("exp-"), k.cast("string"))
    ps = param_specs(spark, sf_dir).withColumn("k", F.substring("experiment", 5, 10).cast("int"))
    kk = F.col("k")
    ps = (ps.withColumn("list", F.when((F.col("name") == "ne") & (kk % 6 == 1), F.array(F.lit("1"))).otherwise(F.col("list")))
            .withColumn("min", F.when((F.col("name") == "booster") & (kk % 10 == 3), F.lit("0")).otherwise(F.col("min"))))
    dup = ps.filter((F.col("name") == "lr") & (kk % 14 == 13)).withColumn("pos", F.lit(4))
    ps = ps.unionByName(dup)
    params = ps.groupBy("experiment").agg(F.sort_array(F.collect_list(F.struct(
        "pos", "name", "type", "min", "max", "step", "list"))).alias("p"))
    params = params.select("experiment", F.transform("p", lambda x: x.dropFields("pos")).alias("params"))
    odd = k % 2 == 1
    e = n.select(
        exp.alias("experiment"),
        F.when(k % 9 == 4, F.concat(F.lit("Exp-"), k.cast("string"))).otherwise(exp).alias("name"),
        F.when(k % 11 == 3, F.lit(0)).otherwise(F.lit(20) + k * 3).cast("int").alias("max_trial_count"),
        F.when(k % 7 == 2, F.lit(100)).otherwise(F.lit(3) + k % 5).cast("int").alias("parallel_trial_count"),
        F.when(k % 13 == 5, F.lit(-1)).otherwise(F.lit(5) + k).cast("int").alias("max_failed_trial_count"),
        F.when(k % 12 == 6, F.lit("maximise")).when(odd, F.lit("minimize")).otherwise(F.lit("maximize")).alias("objective_type"),
        F.when(k % 10 == 8, F.lit("")).otherwise(F.lit("purchase")).alias("objective_metric"),
        F.when(k % 8 == 7, F.array(F.lit("purchase"))).when(odd, F.array(F.lit("error")))
         .otherwise(F.array(F.lit("view"), F.lit("click"))).alias("additional_metrics"),
        F.when(k % 15 == 14, F.lit("")).otherwise(_pick(k, ALGORITHMS)).alias("algorithm"),
        F.when(k % 10 == 9, F.lit("Sometimes")).otherwise(_pick(k, ["Never", "LongRunning", "FromVolume"])).alias("resume_policy"),
        (k % 8 == 7).alias("is_nas"))
    return e.join(params, "experiment", "left")


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deployed job of every trial: (trial, job_name, job_conditions)."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")

    def cond(t):
        return F.array(F.struct(F.lit(t).alias("type"), F.lit("True").alias("status")))

    jc = (F.when(k % 4 == 0, cond("Complete")).when(k % 4 == 1, cond("Failed")).when(k % 4 == 2, cond("Running"))
          .otherwise(F.array().cast("array<struct<type:string,status:string>>")))
    trial = F.concat(F.lit("trial-"), k.cast("string"))
    return c.select(trial.alias("trial"), F.when(k % 9 == 0, F.lit("")).otherwise(F.concat(F.lit("job-"), trial)).alias("job_name"),
                    jc.alias("job_conditions"))
