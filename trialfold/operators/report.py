"""Reporting queries (O57–O66): listings, trial tables, curves, NAS views,
gauges and headlines, all as one plan over every experiment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trialfold.functions.exprs import num, small, time_key
from trialfold.operators.state import last_condition

# Experiment condition messages by reason.
REASON_MESSAGE = [
    ("ExperimentGoalReached", "Experiment has succeeded because Objective goal has reached"),
    ("ExperimentFailed", "Experiment has failed because max failed count has reached"),
    ("ExperimentMaxTrialsReached", "Experiment has succeeded because max trial count has reached"),
    ("ExperimentSuggestionEndReached", "Experiment has succeeded because suggestion service has reached the end"),
    ("ExperimentRunning", "Experiment is running"),
]
NAS_ALGORITHMS = ["enas", "darts"]


def reason_message(reason: Column) -> Column:
    out = F.lit(None).cast("string")
    for r, m in REASON_MESSAGE:
        out = F.when(reason == r, F.lit(m)).otherwise(out)
    return out


def experiment_conditions(verdicts: DataFrame) -> DataFrame:
    """Condition list of every experiment derived from its verdict:
    Created, Running (True only while running), then the final one."""
    st = F.col("status")
    conds = F.array(
        F.struct(F.lit("Created").alias("type"), F.lit("True").alias("status"), F.lit("Experiment is created").alias("message")),
        F.struct(F.lit("Running").alias("type"), F.when(st == "Running", F.lit("True")).otherwise(F.lit("False")).alias("status"),
                 F.lit("Experiment is running").alias("message")),
        F.when(st != "Running", F.struct(st.alias("type"), F.lit("True").alias("status"),
                                         reason_message(F.col("reason")).alias("message"))))
    return verdicts.select("experiment", F.filter(conds, lambda c: c.isNotNull()).alias("conditions"))


def experiment_listing(experiments: DataFrame, conditions: DataFrame, namespaces: list[str]) -> DataFrame:
    """Experiments of the given namespaces: name, namespace, type
    ('nas' when a NAS config is present, else 'hp'), last condition."""
    e = experiments.filter(F.col("namespace").isin(namespaces)).join(conditions, "experiment")
    typ = F.when(F.col("algorithm").isin(NAS_ALGORITHMS), F.lit("nas")).otherwise(F.lit("hp"))
    return e.select("experiment", "namespace", typ.alias("type"), last_condition(F.col("conditions")).alias("last_condition"))


def _direction_candidates(o: DataFrame, keys: list[str]) -> DataFrame:
    """Per key the first value and the first minimum / maximum (earliest on
    ties) — computed before the direction is known, so the aggregate runs
    on the raw rows with map-side combine and the direction is applied
    after the (much smaller) result is joined with the trials."""
    isnum = F.col("x").isNotNull()
    return o.groupBy(*keys).agg(
        F.min_by("value", F.when(isnum, F.struct("x", "tk", "seq"))).alias("lo"),
        F.min_by("value", F.when(isnum, F.struct((-F.col("x")).alias("nx"), "tk", "seq"))).alias("hi"),
        F.min_by("value", F.struct("tk", "seq")).alias("first"))


def _by_direction(objective_type: Column) -> Column:
    return (F.when(objective_type == "minimize", F.coalesce("lo", "first"))
             .when(objective_type == "maximize", F.coalesce("hi", "first")).otherwise(F.col("first")))


def best_metric_values(obs: DataFrame, trials_state: DataFrame, experiments: DataFrame) -> DataFrame:
    """Per (trial, metric of the experiment) the best logged value in the
    objective's direction (first one on ties; a non-numeric log keeps the
    first value), only for Succeeded / EarlyStopped trials."""
    o = obs.withColumn("x", num("value")).withColumn("tk", time_key(F.col("ts")))
    g = _direction_candidates(o, ["trial", "metric"])
    e = small(experiments.select("experiment", "objective_type",
                                 F.concat(F.array("objective_metric"), F.col("additional_metrics")).alias("metrics")))
    t = trials_state.filter(F.col("state").isin("Succeeded", "EarlyStopped")).select("trial", "experiment").join(e, "experiment")
    j = g.join(t, "trial").filter(F.array_contains("metrics", F.col("metric")))
    return j.select("trial", "metric", _by_direction(F.col("objective_type")).alias("value"))


def trial_table(trials_state: DataFrame, best: DataFrame, assignments: DataFrame, metric_names: list[str],
                param_names: list[str], annotations: DataFrame) -> DataFrame:
    """One row per trial: last condition, name, best metric values
    and parameter values as columns (explicit pivot value lists, so no
    extra distinct job), and the run-id column (always present, NULL when
    a trial has no run annotation)."""
    m = best.groupBy("trial").pivot("metric", metric_names).agg(F.first("value"))
    p = (assignments.select("trial", F.explode("assignments").alias("a"))
         .select("trial", F.col("a.name").alias("pname"), F.col("a.value").alias("pvalue"))
         .groupBy("trial").pivot("pname", param_names).agg(F.first("pvalue")))
    t = trials_state.select("experiment", "trial", last_condition(F.col("conditions")).alias("last_condition"))
    return (t.join(m, "trial", "left").join(p, "trial", "left").join(annotations, "trial", "left")
            .select("experiment", "last_condition", "trial", *metric_names, *param_names, "kfp_run"))


def per_second_curve(obs: DataFrame, trials: DataFrame, experiments: DataFrame) -> DataFrame:
    """Per (trial, metric) one point per second: the best value of that
    second in the objective's direction, first one on ties.  Output
    (trial, metric, second, value)."""
    o = obs.withColumn("x", num("value")).filter(F.col("x").isNotNull())
    o = o.withColumn("sec", F.coalesce(F.date_format(F.date_trunc("second", "ts"), "yyyy-MM-dd'T'HH:mm:ss"),
                                       F.lit("0001-01-01T00:00:00")))
    o = o.withColumn("tk", time_key(F.col("ts")))
    g = _direction_candidates(o, ["trial", "metric", "sec"])
    e = small(experiments.select("experiment", "objective_type"))
    j = g.join(trials.select("trial", "experiment"), "trial").join(e, "experiment")
    return j.select("trial", "metric", F.col("sec").alias("second"), _by_direction(F.col("objective_type")).alias("value"))


def curve_bounds(points: DataFrame) -> DataFrame:
    """Per trial the number of points per metric and the chart's y
    range: minimum floored and maximum ceiled to 0.1."""
    series = points.select("trial", "metric", num("value").alias("x")).groupBy("trial", "metric").agg(
        F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    return series.groupBy("trial").agg(F.sum("n").alias("n_points"), F.count("*").alias("n_series"),
                                       (F.floor(F.min("lo") * 10) / 10).alias("y_min"),
                                       (F.ceil(F.max("hi") * 10) / 10).alias("y_max"))


def architecture_json(k: Column, n_ops: int = 11) -> Column:
    """A layer list ``[[op], [op, skip], ...]`` derived from an integer key:
    2 + k%3 layers, op = (7k + 3i) % n_ops, skip j of layer i set when
    (k + i*j) % 3 == 0."""
    layers = F.sequence(F.lit(0), (F.lit(1) + k % 3).cast("int"))

    def layer(i):
        op = ((k * 7 + i * 3) % n_ops).cast("string")
        skips = F.transform(F.sequence(F.lit(1), F.greatest(i, F.lit(1))),
                            lambda j: F.when((k + i * j) % 3 == 0, F.lit("1")).otherwise(F.lit("0")))
        skips = F.when(i > 0, skips).otherwise(F.array().cast("array<string>"))
        return F.concat(F.lit("["), F.array_join(F.concat(F.array(op), skips), ", "), F.lit("]"))

    return F.concat(F.lit("["), F.array_join(F.transform(layers, layer), ", "), F.lit("]"))


def with_list_index(df: DataFrame, group, order: str, bucket: int = 4096, name: str = "idx") -> DataFrame:
    """Adds ``name`` = 0-based position of each row inside its group by the
    unique ``order`` column, skew-safe: per-(group, bucket) counts, their
    prefix sums per group (one row per bucket), and a row_number inside the
    bucket (at most ``bucket`` rows)."""
    g = [group] if isinstance(group, str) else list(group)
    b = df.withColumn("_bk", F.floor(F.col(order) / bucket))
    counts = b.groupBy(*g, "_bk").agg(F.count("*").alias("_n"))
    wp = Window.partitionBy(*g).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.withColumn("_off", F.coalesce(F.sum("_n").over(wp), F.lit(0))).drop("_n")
    wr = Window.partitionBy(*g, "_bk").orderBy(order)
    r = b.join(offs, [*g, "_bk"]).withColumn(name, (F.col("_off") + F.row_number().over(wr) - 1).cast("long"))
    return r.drop("_bk", "_off")


def nas_trial_view(trials_state: DataFrame, obs: DataFrame, arch: DataFrame) -> DataFrame:
    """Succeeded trials with 'Generation i' (i = index in the trial
    list), architecture, and their metric log in long form (ordered by
    (ts, seq)); never packed into one row."""
    t = with_list_index(trials_state.select("experiment", "trial", "state", "pos"), "experiment", "pos")
    t = t.filter(F.col("state") == "Succeeded").join(arch, "trial")
    o = obs.join(t, "trial")
    return o.select("experiment", "trial", F.concat(F.lit("Generation "), F.col("idx").cast("string")).alias("generation"),
                    "architecture", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"), "seq", "metric", "value")


def architecture_graph(arch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges and node ids of every architecture.  Chain edge i -> i+1;
    skip edge j-1 -> i+1 when flag j of layer i is 1; then layer L ->
    GlobalAvgPool -> FullConnect/Softmax -> Output.  Returns (edges
    (trial, src, dst), layers (trial, node, op_id))."""
    a = arch.withColumn("m", F.from_json("architecture", "array<array<int>>"))
    L = F.size("m")
    layers = a.select("experiment", "trial", F.posexplode("m").alias("i", "row"))
    chain = layers.select("trial", F.col("i").alias("src"), (F.col("i") + 1).alias("dst"))
    skips = (layers.select("trial", "i", F.posexplode("row").alias("j", "flag"))
             .filter((F.col("j") >= 1) & (F.col("flag") == 1))
             .select("trial", (F.col("j") - 1).alias("src"), (F.col("i") + 1).alias("dst")))
    tail = a.select("trial", F.explode(F.array(
        F.struct(L.alias("src"), (L + 1).alias("dst")), F.struct((L + 1).alias("src"), (L + 2).alias("dst")),
        F.struct((L + 2).alias("src"), (L + 3).alias("dst")))).alias("e")).select("trial", "e.src", "e.dst")
    edges = chain.unionByName(skips).unionByName(tail)
    nodes = layers.select("experiment", "trial", (F.col("i") + 1).alias("node"), F.element_at("row", 1).alias("op_id"))
    return edges, nodes


def node_label(op_type: Column, params: Column) -> Column:
    """Quoted node label: the operation's type, then its parameters
    ('name=value;...') on a line of their own, if it has any."""
    detail = F.concat(F.lit("\\n"), F.replace(params, F.lit(";"), F.lit(", ")))
    return F.concat(F.lit('"'), F.coalesce(op_type, F.lit("")), F.when(params != "", detail).otherwise(F.lit("")), F.lit('"'))


def parallel_axes(table: DataFrame, specs: DataFrame, experiments: DataFrame) -> DataFrame:
    """Axes of the parallel-coordinates chart per experiment: the
    parameters in spec order, then the objective; numeric axes get max *
    1.1 of their values, categorical axes the sorted distinct values.
    ``table``: long (experiment, trial, axis, value)."""
    ax = specs.select("experiment", "pos", F.col("name").alias("axis"), (F.col("type") == "categorical").alias("categorical"))
    obj = experiments.select("experiment", F.lit(1 << 20).alias("pos"), F.col("objective_metric").alias("axis"),
                             F.lit(False).alias("categorical"))
    ax = ax.unionByName(obj)
    v = table.join(ax, ["experiment", "axis"])
    g = v.groupBy("experiment", "axis", "pos", "categorical").agg(
        F.max(num("value")).alias("mx"), F.array_join(F.array_sort(F.collect_set("value")), ",").alias("cats"))
    w = Window.partitionBy("experiment").orderBy("pos")
    return g.select("experiment", (F.row_number().over(w) - 1).cast("int").alias("dim"), "axis",
                    F.when(~F.col("categorical"), F.round(F.col("mx") + 0.1 * F.col("mx"), 9)).alias("max"),
                    F.when(F.col("categorical"), F.col("cats")).alias("categories"))


def state_gauges(trials_state: DataFrame) -> DataFrame:
    """Trials by (namespace, last condition) with rollup subtotals."""
    t = trials_state.select("namespace", last_condition(F.col("conditions")).alias("last_condition"))
    return t.rollup("namespace", "last_condition").agg(F.count("*").alias("trials"))


# Counter name by condition type.
COUNTERS = [("Created", "created"), ("Succeeded", "succeeded"), ("Failed", "failed"), ("Killed", "deleted"),
            ("MetricsUnavailable", "metrics_unavailable")]


def state_change_totals(trials: DataFrame) -> DataFrame:
    """O65 counters: per namespace the totals of state changes (a trial's
    true conditions) as created / succeeded / failed / deleted /
    metrics_unavailable — the batch form of the running counters."""
    c = trials.select("namespace", F.explode("conditions").alias("c")).filter(F.col("c.status") == "True")
    name = F.lit(None).cast("string")
    for t, n in COUNTERS:
        name = F.when(F.col("c.type") == t, F.lit(n)).otherwise(name)
    return c.select("namespace", name.alias("counter")).filter(F.col("counter").isNotNull()).groupBy(
        "namespace", "counter").agg(F.count("*").alias("total"))


def status_headline(verdicts: DataFrame, conditions: DataFrame, experiments: DataFrame) -> DataFrame:
    """Message of the first true condition among Succeeded > Failed >
    Running > Restarting > Created, and the goal text 'metric > goal'
    ('<' for minimize)."""
    c = conditions
    msg = F.lit(None).cast("string")
    for t in reversed(["Succeeded", "Failed", "Running", "Restarting", "Created"]):
        first = F.try_element_at(F.filter("conditions", lambda x: x["type"] == t), F.lit(1))
        msg = F.when(first["status"] == "True", first["message"]).otherwise(msg)
    e = experiments.select("experiment", "objective_metric", "objective_type", "goal")
    goal_txt = F.coalesce(F.regexp_replace(F.col("goal").cast("string"), r"\.0$", ""), F.lit("undefined"))
    op = F.when(F.col("objective_type") == "maximize", F.lit(">")).otherwise(F.lit("<"))
    return c.join(e, "experiment").select("experiment", msg.alias("status_message"),
                                          F.concat_ws(" ", "objective_metric", op, goal_txt).alias("goal_text"))
