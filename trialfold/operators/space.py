"""Search-space expansion, sampling, matching, templates, validation
(O40–O56).

Spaces are tables ``param_specs(experiment, pos, name, type, min, max,
step, list)``; every operator handles all experiments at once.  Random
draws are md5-based (same in any partitioning and in plain SQL); grids are
decoded from a row index in mixed radix instead of chained cross joins,
and the index range is split into chunks so one huge grid spreads over
many tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trialfold.functions.exprs import md5_uniform, small

GRID_CHUNK = 4096


def _d(c: str) -> Column:
    return F.col(c).try_cast("double")


#: Values that one row may list (``axis_values``; ``axis_rows`` and ``grid_product`` list none).
MAX_AXIS = 1_000_000
#: Sizes and products stop here.
LARGEST = 2**63 - 1


def _saturated(c: Column) -> Column:
    return F.least(c.cast("decimal(38,0)"), F.lit(LARGEST).cast("decimal(38,0)")).cast("long")


def _product(sizes: Column) -> Column:
    """Product of an array of sizes; it stops at LARGEST and never overflows,
    as two factors of 63 bits fit a decimal of 38 digits."""
    return F.aggregate(sizes, F.lit(1).cast("long"), lambda a, b: _saturated(a.cast("decimal(19,0)") * b.cast("decimal(19,0)")))


def grid_axes(specs: DataFrame) -> DataFrame:
    """Per (experiment, param) the grid axis as (start, step, size); its
    values are made where they are asked for (``axis_value``).
    int: min..max by step (default 1) inclusive; double: arange(min,
    max+step, step) with the last value dropped when above max (step
    required); categorical/discrete: the list.  An axis that can't be laid out
    is an ``error`` of its own experiment.  Sizes stop at LARGEST."""
    t = F.col("type")
    dec = "decimal(20,0)"
    step_i = F.coalesce(F.nullif(F.col("step"), F.lit("")), F.lit("1")).try_cast("long")
    lo_i, hi_i = F.col("min").try_cast("long"), F.col("max").try_cast("long")
    n_int = F.greatest(F.ceil((hi_i.cast(dec) + 1 - lo_i.cast(dec)) / F.nullif(step_i, F.lit(0)).cast(dec)), F.lit(0))
    lo_d, hi_d, st_d = _d("min"), _d("max"), _d("step")
    steps = (hi_d + st_d - lo_d) / F.nullif(st_d, F.lit(0.0))
    raw = F.when(steps <= 0, 0.0).when(steps < 9.0e18, F.ceil(steps).cast("double")).otherwise(F.when(steps.isNotNull(), float(LARGEST)))
    # arange then drop the last value when it overshoots max
    n_dbl = F.when((raw > 0) & (raw < 9.0e18) & (lo_d + (raw - 1) * st_d > hi_d), raw - 1).otherwise(raw)
    size = (F.when(t == "int", _saturated(n_int))
            .when(t == "double", F.when(n_dbl >= 9.0e18, F.lit(LARGEST)).otherwise(n_dbl.cast("long")))
            .when(t.isin("categorical", "discrete"), F.coalesce(F.size("list"), F.lit(0)).cast("long")))
    error = (F.when((t == "double") & st_d.isNull(), F.lit("step is required for a double grid axis"))
             .when(((t == "double") & (st_d == 0)) | ((t == "int") & (step_i == 0)), F.lit("step must not be zero")))
    return (specs.withColumn("start_i", lo_i).withColumn("step_i", step_i).withColumn("start_d", lo_d).withColumn("step_d", st_d)
            .withColumn("size", F.when(error.isNull(), F.coalesce(size, F.lit(0))).otherwise(F.lit(0)).cast("long")).withColumn("error", error))


def axis_value(i: Column) -> Column:
    """The value at place ``i`` (long, from 0) of a row of ``grid_axes``: (num, text)."""
    t = F.col("type")
    whole = F.col("start_i") + i * F.col("step_i")
    item = F.get(F.col("list"), i.try_cast("int"))
    return (F.when(t == "int", F.struct(whole.cast("double").alias("num"), whole.cast("string").alias("text")))
            .when(t == "double", F.struct((F.col("start_d") + i * F.col("step_d")).alias("num"), F.lit(None).cast("string").alias("text")))
            .otherwise(F.struct(item.try_cast("double").alias("num"), item.alias("text"))))


def _counted(df: DataFrame, n: str, name: str) -> DataFrame:
    """Each row ``n`` times (a long of any size), numbered from 0: four steps of
    at most 2^17 numbers each, and chunks of GRID_CHUNK dealt out over tasks."""
    last = F.col(n) - 1
    out = df.where(F.col(n) > 0).withColumn(name, F.explode(F.sequence(F.lit(0).cast("long"), F.shiftright(last, 46))))
    for above, shift in ((17, 29), (17, 12)):
        start = F.shiftleft(name, above)
        out = out.withColumn(name, F.explode(F.sequence(start, F.least(start + ((1 << above) - 1), F.shiftright(last, shift)))))
    out = out.repartition("experiment", name)
    start = F.col(name) * GRID_CHUNK
    return out.withColumn(name, F.explode(F.sequence(start, F.least(start + (GRID_CHUNK - 1), last))))


def axis_rows(axes: DataFrame) -> DataFrame:
    """O40 as rows (experiment, pos, name, idx, num, text); no row holds an axis."""
    v = axis_value(F.col("idx"))
    return _counted(axes, "size", "idx").select("experiment", "pos", "name", "idx", v["num"].alias("num"), v["text"].alias("text"))


def axis_values(specs: DataFrame) -> DataFrame:
    """O40 with the ``values`` of each axis as an array, for short axes (those of
    operations): a longer one than MAX_AXIS is its experiment's error."""
    a = grid_axes(specs)
    error = F.when(F.col("error").isNotNull(), F.col("error")).when(F.col("size") > MAX_AXIS, F.lit("the grid axis has too many values to list"))
    n = F.when(F.col("size") <= MAX_AXIS, F.col("size")).otherwise(F.lit(0))
    places = F.when(n > 0, F.sequence(F.lit(0).cast("long"), n - 1)).otherwise(F.array().cast("array<bigint>"))
    values = F.when((F.col("type") == "double") & F.col("error").isNotNull(), F.lit(None)).otherwise(F.transform(places, axis_value))
    return a.withColumn("values", values).withColumn("error", error).drop("start_i", "step_i", "start_d", "step_d")


def grid_size(axes: DataFrame, experiments: DataFrame) -> DataFrame:
    """Product of the axis sizes (never materialised, stops at LARGEST);
    invalid when maxTrialCount exceeds it."""
    g = axes.groupBy("experiment").agg(
        _product(F.collect_list("size")).alias("grid_size"), F.max(F.col("error").isNotNull()).alias("has_error"))
    return (g.join(small(experiments.select("experiment", "max_trial_count")), "experiment")
            .select("experiment", "grid_size", "max_trial_count",
                    (~F.col("has_error") & (F.col("max_trial_count") <= F.col("grid_size"))).alias("valid")))


def grid_product(axes: DataFrame) -> DataFrame:
    """Every combination of all axes (last axis fastest, as an
    itertools product), decoded from the combination index; values are made
    from (start, step), so no array of them travels.
    Output (experiment, combo, pos, name, value_num, value_text)."""
    sizes = axes.groupBy("experiment").agg(F.collect_list(F.struct("pos", "size")).alias("sizes"))
    tot = sizes.select("experiment", _product(F.transform("sizes", lambda z: z["size"])).alias("n"))
    a = axes.join(small(sizes), "experiment").withColumn(
        "stride", _product(F.transform(F.filter("sizes", lambda z: z["pos"] > F.col("pos")), lambda z: z["size"]))).drop("sizes")
    j = _counted(tot, "n", "combo").drop("n").join(small(a), "experiment")
    j = j.withColumn("v", axis_value(F.floor(F.col("combo") / F.col("stride").cast("decimal(20,0)")).cast("long") % F.col("size")))
    return j.select("experiment", "combo", "pos", "name", F.col("v.num").alias("value_num"), F.col("v.text").alias("value_text"))


# ------------------------------------------------------------------ sampling

def _bounds(specs: DataFrame) -> DataFrame:
    t = F.col("type")
    ints = F.transform(F.coalesce(F.col("list"), F.array().cast("array<string>")), lambda v: v.try_cast("double"))
    lo = F.when(t.isin("int", "double"), _d("min")).when(t == "discrete", F.array_min(ints))
    hi = F.when(t.isin("int", "double"), _d("max")).when(t == "discrete", F.array_max(ints))
    dims = F.when(t == "categorical", F.size("list")).otherwise(F.lit(1))
    return specs.withColumn("lo", lo).withColumn("hi", hi).withColumn("dims", dims)


def uniform_sample(specs: DataFrame, counts: DataFrame, seed: int = 0) -> DataFrame:
    """O43 + O44: ``counts`` (experiment, n) samples per experiment; each
    sample a uniform vector over the space (categorical params span one
    one-hot dimension per value) mapped back to an assignment: int ->
    round half-even, double as is, discrete -> nearest feasible (first on
    tie), categorical -> argmax of its block (first on tie).
    Output (experiment, sample, pos, name, value_num, value_text)."""
    b = _bounds(specs)
    s = counts.select("experiment", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("sample"))
    j = s.join(small(b.select("experiment", "pos", "name", "type", "list", "lo", "hi", "dims")), "experiment")
    u = F.transform(F.sequence(F.lit(0), F.col("dims") - 1),
                    lambda d: md5_uniform(F.lit(seed), F.col("experiment"), F.col("sample"), F.col("pos"), d))
    x = F.col("lo") + F.element_at(u, 1) * (F.col("hi") - F.col("lo"))
    t = F.col("type")
    disc = F.array_min(F.transform(F.col("list"), lambda v, i: F.struct(F.abs(v.try_cast("double") - x).alias("dist"),
                                                                        i.alias("i"), v.alias("v"))))["v"]
    cat = F.element_at(F.col("list"), F.array_position(u, F.array_max(u)).cast("int"))
    num = (F.when(t == "int", F.bround(x, 0)).when(t == "double", x).when(t == "discrete", disc.try_cast("double")))
    text = (F.when(t == "int", F.bround(x, 0).cast("long").cast("string")).when(t == "discrete", disc)
            .when(t == "categorical", cat))
    return j.select("experiment", "sample", "pos", "name", F.round(num, 9).alias("value_num"), text.alias("value_text"))


# (library, parameter type) -> sampling mode
LIBRARY_MODES = {
    "optuna": {"int": "int_uniform", "double": "uniform", "categorical": "choice", "discrete": "choice"},
    "hyperopt": {"int": "quantised", "double": "uniform", "categorical": "choice", "discrete": "choice"},
    "skopt": {"int": "int_uniform", "double": "log_uniform", "categorical": "choice", "discrete": "choice"},
    "goptuna": {"int": "stepped", "double": "stepped", "categorical": "choice", "discrete": "choice"},
}


def library_sample(specs: DataFrame, counts: DataFrame, library: str, seed: int = 0) -> DataFrame:
    """One sampler, mode picked per (library, parameter type):
    uniform ``lo+u(hi-lo)``; int_uniform ``lo+floor(u(hi-lo+1))``;
    quantised ``round(uniform/q)*q``; log_uniform ``exp(ln lo+u(ln hi-ln
    lo))``; stepped ``lo+floor(u(floor((hi-lo)/q)+1))*q`` (plain uniform
    when no step); choice ``list[floor(u*n)]``.
    Output (experiment, sample, pos, name, mode, value_num, value_text)."""
    modes = LIBRARY_MODES[library]
    t = F.col("type")
    mode = F.lit(None).cast("string")
    for k, v in modes.items():
        mode = F.when(t == k, F.lit(v)).otherwise(mode)
    s = counts.select("experiment", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("sample"))
    j = s.join(small(specs.select("experiment", "pos", "name", "type", "min", "max", "step", "list")), "experiment")
    u = md5_uniform(F.lit(seed), F.lit(library), F.col("experiment"), F.col("sample"), F.col("pos"))
    return _drawn(j.withColumn("mode", mode), u).select("experiment", "sample", "pos", "name", "mode", "value_num", "value_text")


def _drawn(j: DataFrame, u: Column) -> DataFrame:
    """``value_num`` and ``value_text`` of the point ``u`` by each row's ``mode``."""
    t, m = F.col("type"), F.col("mode")
    lo, hi = _d("min"), _d("max")
    q = F.coalesce(F.nullif(F.col("step"), F.lit("")).try_cast("double"), F.lit(1.0))
    has_step = F.coalesce(F.col("step"), F.lit("")) != ""
    x = (F.when(m == "uniform", lo + u * (hi - lo))
         .when(m == "int_uniform", lo + F.floor(u * (hi - lo + 1)))
         .when(m == "quantised", F.round((lo + u * (hi - lo)) / q) * q)
         .when(m == "log_uniform", F.exp(F.log(lo) + u * (F.log(hi) - F.log(lo))))
         .when((m == "stepped") & has_step, lo + F.floor(u * (F.floor((hi - lo) / q) + 1)) * q)
         .when((m == "stepped") & (t == "int"), lo + F.floor(u * (hi - lo + 1)))
         .when(m == "stepped", lo + u * (hi - lo)))
    choice = F.try_element_at(F.col("list"), (F.floor(u * F.size("list")) + 1).cast("int"))
    return (j.withColumn("value_num", F.round(F.when(m == "choice", choice.try_cast("double")).otherwise(x), 9))
            .withColumn("value_text", F.when(m == "choice", choice)))


# The published first direction integers (Joe and Kuo, 2008) of
# Sobol dimensions 2 to 21, in the order of their primitive polynomials.
FIRST_DIRECTIONS = [
    (1,), (1, 3), (1, 3, 1), (1, 1, 1), (1, 1, 3, 3), (1, 3, 5, 13), (1, 1, 5, 5, 17), (1, 1, 5, 5, 5), (1, 1, 7, 11, 19),
    (1, 1, 5, 1, 1), (1, 1, 1, 3, 11), (1, 3, 5, 5, 31), (1, 3, 3, 9, 7, 49), (1, 1, 1, 15, 21, 21), (1, 3, 1, 13, 27, 49),
    (1, 1, 1, 15, 7, 5), (1, 3, 1, 15, 13, 25), (1, 1, 5, 5, 19, 61), (1, 3, 7, 11, 23, 15, 103), (1, 3, 7, 13, 13, 15, 69)]
SOBOL_BITS = 32


def _primitive_polynomials() -> Iterator[tuple[int, int]]:
    """(degree, polynomial as bits) over two elements, by degree, then value:
    those for which the powers of x run through all residues."""
    degree = 0
    while True:
        degree += 1
        for poly in range((1 << degree) | 1, 2 << degree, 2):
            x, order = 1, 0
            while True:
                x <<= 1
                x ^= poly * (x >> degree & 1)
                order += 1
                if x <= 1:
                    break
            if x == 1 and order == (1 << degree) - 1:
                yield degree, poly


def sobol_directions(dims: int) -> list[list[int]]:
    """The 32 direction numbers of each dimension.  Beyond the published first
    integers, odd ones come from a hash of the dimension."""
    out = [[1 << (SOBOL_BITS - k) for k in range(1, SOBOL_BITS + 1)]]
    for dim, (degree, poly) in zip(range(2, dims + 1), _primitive_polynomials(), strict=False):
        if dim - 2 < len(FIRST_DIRECTIONS):
            first = FIRST_DIRECTIONS[dim - 2]
        else:
            first = [int(hashlib.md5(f"{dim}|{k}".encode()).hexdigest(), 16) % (1 << k) | 1 for k in range(1, degree + 1)]
        v = [m << (SOBOL_BITS - k) for k, m in enumerate(first, 1)]
        while len(v) < SOBOL_BITS:
            new = v[-degree] ^ (v[-degree] >> degree)
            for i in range(1, degree):
                new ^= v[-i] * (poly >> (degree - i) & 1)
            v.append(new)
        out.append(v)
    return out[:dims]


def sobol_sample(specs: DataFrame, counts: DataFrame) -> DataFrame:
    """Sobol points in gray-code order, one dimension for each parameter
    in the order of the space.  Numbers are scaled to [min, max] and kept on
    their step, integers are whole, lists are chosen by index (as O45's
    ``stepped`` and ``choice``).  The widest space decides how many direction
    numbers are made (one aggregate over the specs).
    Output (experiment, sample, pos, name, u, value_num, value_text)."""
    mode = F.when(F.col("type").isin("int", "double"), F.lit("stepped")).otherwise(F.lit("choice"))
    dims = specs.groupBy("experiment").count().agg(F.max("count")).first()[0] or 0
    w = Window.partitionBy("experiment").orderBy("pos")
    axes = specs.withColumn("dim", F.row_number().over(w)).withColumn("mode", mode)
    rows = [(i, v) for i, v in enumerate(sobol_directions(dims), 1)] if dims else []
    table = specs.sparkSession.createDataFrame(rows, "dim int, v array<long>")
    axes = axes.join(F.broadcast(table), "dim")  # one row for each parameter of the widest space
    s = counts.filter(F.col("n") > 0).select(
        "experiment", F.explode(F.sequence(F.lit(0), F.col("n").cast("int") - 1)).alias("sample"))
    j = s.join(small(axes), "experiment")
    n = F.col("sample").cast("long")
    gray = n.bitwiseXOR(F.shiftright(n, 1))
    xi = F.aggregate(F.sequence(F.lit(0), F.lit(SOBOL_BITS - 1)), F.lit(0).cast("long"),
                     lambda acc, k: F.when(F.getbit(gray, k) == 1, acc.bitwiseXOR(F.element_at("v", k + 1))).otherwise(acc))
    j = j.withColumn("u", xi.cast("double") / F.lit(float(1 << SOBOL_BITS)))
    return _drawn(j, F.col("u")).select("experiment", "sample", "pos", "name", F.round("u", 12).alias("u"), "value_num", "value_text")


# ---------------------------------------------------------------- NAS spaces

def nas_operations(ops: DataFrame) -> DataFrame:
    """Per operation type the product of its parameter values, with a
    running id across types in list order.  ``ops``: (experiment, op_pos,
    op_type, params array<struct<name,type,min,max,step,list>>).
    Output (experiment, op_id, op_type, params 'name=value;...')."""
    p = ops.select("experiment", "op_pos", "op_type", F.posexplode_outer("params").alias("ppos", "p"))
    p = p.select("experiment", "op_pos", "op_type", "ppos", F.col("p.name").alias("name"), F.col("p.type").alias("type"),
                 F.col("p.min").alias("min"), F.col("p.max").alias("max"), F.col("p.step").alias("step"),
                 F.col("p.list").alias("list"))
    ax = axis_values(p.withColumn("pos", F.col("ppos")))
    per_op = ax.groupBy("experiment", "op_pos", "op_type").agg(
        F.sort_array(F.collect_list(F.struct("ppos", "name", "size", "values"))).alias("axes"))
    per_op = per_op.withColumn("axes", F.filter("axes", lambda a: a["name"].isNotNull()))
    per_op = per_op.withColumn("n", _product(F.transform("axes", lambda a: a["size"])))
    w = Window.partitionBy("experiment").orderBy("op_pos").rowsBetween(Window.unboundedPreceding, -1)
    per_op = per_op.withColumn("base", F.coalesce(F.sum("n").over(w), F.lit(0)))
    x = _counted(per_op.select("experiment", "op_type", "axes", "base", "n"), "n", "i")
    k = F.size("axes")

    def digit(j):
        later = F.slice(F.col("axes"), j + 2, k)
        stride = _product(F.transform(later, lambda a: a["size"]))
        ax_j = F.element_at(F.col("axes"), j + 1)
        d = (F.floor(F.col("i") / stride) % ax_j["size"]).cast("int")
        v = F.element_at(ax_j["values"], d + 1)
        return F.concat(ax_j["name"], F.lit("="), F.coalesce(v["text"], F.format_number(v["num"], 6)))

    params = F.array_join(F.transform(F.sequence(F.lit(0), F.greatest(k - 1, F.lit(0))),
                                      lambda j: F.when(k > 0, digit(j))), ";")
    return x.select("experiment", (F.col("base") + F.col("i")).alias("op_id"), "op_type", params.alias("params"))


def nas_primitives(ops: DataFrame) -> DataFrame:
    """O48: 'skip_connection' alone, else ``type_KxK`` for each value of the
    operation's first parameter.  Output (experiment, op_pos, idx, primitive)."""
    first = F.try_element_at(F.col("params"), F.lit(1))
    vals = F.when(F.col("op_type") == "skip_connection", F.array(F.lit(None).cast("string"))).otherwise(first["list"])
    x = ops.select("experiment", "op_pos", "op_type", F.posexplode(vals).alias("idx", "v"))
    prim = F.when(F.col("op_type") == "skip_connection", F.col("op_type")).otherwise(
        F.concat(F.col("op_type"), F.lit("_"), F.col("v"), F.lit("x"), F.col("v")))
    return x.select("experiment", "op_pos", F.col("idx").cast("int").alias("idx"), prim.alias("primitive"))


def settings_overlay(base: DataFrame, over: DataFrame) -> DataFrame:
    """Stored settings overwrite base settings by name (base order
    kept), settings only in ``over`` appended in their order.
    Inputs (experiment, pos, name, value).  Output (experiment, pos, name, value)."""
    b = base.alias("b").join(over.alias("o"), ["experiment", "name"], "full_outer")
    nb = base.groupBy("experiment").agg(F.count("*").alias("nb"))
    r = b.join(nb, "experiment", "left").select(
        "experiment", "name",
        F.when(F.col("b.pos").isNotNull(), F.col("b.pos")).otherwise(F.coalesce(F.col("nb"), F.lit(0)) + F.col("o.pos")).alias("k"),
        F.coalesce(F.col("o.value"), F.col("b.value")).alias("value"))
    w = Window.partitionBy("experiment").orderBy("k")
    return r.select("experiment", (F.row_number().over(w) - 1).cast("int").alias("pos"), "name", "value")


def encode_trials(assign: DataFrame, objective: DataFrame, specs: DataFrame, experiments: DataFrame) -> DataFrame:
    """One numeric row per trial: numbers as is, categorical one-hot in
    list order (spec order of parameters); objective negated for minimize.
    ``assign`` (experiment, trial, assignments array<struct<name,value>>),
    ``objective`` (trial, value).  Output (experiment, trial, dim, x, y)."""
    sp = specs.groupBy("experiment").agg(F.sort_array(F.collect_list(F.struct("pos", "name", "type", "list"))).alias("sp"))
    a = assign.join(small(sp), "experiment").join(objective.select("trial", F.col("value").alias("obj")), "trial")
    m = F.map_from_entries(F.col("assignments"))
    vec = F.flatten(F.transform("sp", lambda s: F.when(
        s["type"] == "categorical",
        F.transform(s["list"], lambda v: F.when(v == F.element_at(m, s["name"]), F.lit(1.0)).otherwise(F.lit(0.0)))
    ).otherwise(F.array(F.element_at(m, s["name"]).try_cast("double")))))
    e = small(experiments.select("experiment", "objective_type"))
    a = a.join(e, "experiment")
    y = F.when(F.col("objective_type") == "minimize", -F.col("obj").try_cast("double")).otherwise(F.col("obj").try_cast("double"))
    return a.select("experiment", "trial", F.posexplode(vec).alias("dim", "x"), y.alias("y")).select(
        "experiment", "trial", F.col("dim").cast("int").alias("dim"), "x", "y")


def space_bounds(specs: DataFrame) -> DataFrame:
    """Per experiment the (dim, lo, hi) rows of the encoded space."""
    b = _bounds(specs)
    lo = F.when(F.col("type") == "categorical", F.array_repeat(F.lit(0.0), F.col("dims"))).otherwise(F.array(F.col("lo")))
    hi = F.when(F.col("type") == "categorical", F.array_repeat(F.lit(1.0), F.col("dims"))).otherwise(F.array(F.col("hi")))
    g = b.groupBy("experiment").agg(F.sort_array(F.collect_list(F.struct("pos", lo.alias("lo"), hi.alias("hi")))).alias("p"))
    g = g.select("experiment", F.flatten(F.transform("p", lambda s: s["lo"])).alias("lo"),
                 F.flatten(F.transform("p", lambda s: s["hi"])).alias("hi"))
    return g.select("experiment", F.posexplode(F.arrays_zip("lo", "hi")).alias("dim", "b")).select(
        "experiment", F.col("dim").cast("int").alias("dim"), F.col("b.lo").alias("lo"), F.col("b.hi").alias("hi"))


def min_max_scale(encoded: DataFrame, bounds: DataFrame) -> DataFrame:
    """Map [lo, hi] -> [0, 1] per dimension (fitted on the two bound
    rows; a constant dimension maps to 0)."""
    j = encoded.join(small(bounds), ["experiment", "dim"])
    rng = F.col("hi") - F.col("lo")
    return j.select("experiment", "trial", "dim",
                    F.when(rng == 0, F.lit(0.0)).otherwise((F.col("x") - F.col("lo")) / rng).alias("scaled"))


# ------------------------------------------------------------ matching

def assignment_key(assignments: Column) -> Column:
    """``name:value`` pairs sorted by name, joined by ','."""
    return F.array_join(F.transform(F.array_sort(assignments), lambda a: F.concat(a["name"], F.lit(":"), a["value"])), ",")


def fifo_match(suggestions: DataFrame, finished: DataFrame) -> DataFrame:
    """Each finished trial takes the oldest open suggestion with the
    same key (k-th finished with key K <- k-th oldest suggestion with K).
    Inputs (experiment, id/trial, order, key).  Output (experiment, trial,
    suggestion) with suggestion NULL = unknown trial (an error)."""
    from trialfold.operators.report import with_list_index  # skew-safe ranks inside (experiment, key)
    s = with_list_index(suggestions, ["experiment", "key"], "order", name="rn")
    f = with_list_index(finished, ["experiment", "key"], "order", name="rn")
    return f.join(s.select("experiment", "key", "rn", F.col("id").alias("suggestion")), ["experiment", "key", "rn"], "left").select(
        "experiment", "trial", "suggestion")


def newest_running_match(suggestions: DataFrame, finished: DataFrame) -> DataFrame:
    """Like ``fifo_match`` but a trial maps to the newest still-running
    unmapped suggestion with equal parameters."""
    from trialfold.operators.report import with_list_index  # skew-safe ranks inside (experiment, key)
    s = with_list_index(suggestions.filter(F.col("running")).withColumn("_neg", -F.col("order")),
                        ["experiment", "key"], "_neg", name="rn")
    f = with_list_index(finished, ["experiment", "key"], "order", name="rn")
    return f.join(s.select("experiment", "key", "rn", F.col("id").alias("suggestion")), ["experiment", "key", "rn"], "left").select(
        "experiment", "trial", "suggestion")


# ------------------------------------------------------------ templates

# Fixed syntax of a reference to trial metadata: this, a key, a closing brace.
META_OPEN = "${trialSpec."


def _meta_key(reference: Column) -> Column:
    """The metadata key of a reference, empty for a parameter's name."""
    inner = F.substring(reference, len(META_OPEN) + 1, 1 << 30)
    return F.when(reference.startswith(META_OPEN) & reference.endswith("}"), F.rtrim(inner, F.lit("}"))).otherwise(F.lit(""))


def _bracketed(key: Column) -> tuple[Column, Column]:
    """``name[index]`` as (name, index); without brackets (key, empty)."""
    name = F.substring_index(key, "[", 1)
    index = F.substring_index(F.substring_index(key, "[", -1), "]", 1)
    has = key.endswith("]") & key.contains("[")
    return F.when(has, name).otherwise(key), F.when(has, index).otherwise(F.lit(""))


def substitute_template(trials: DataFrame, templates: DataFrame) -> DataFrame:
    """Per trial replace ``${trialParameters.N}`` by the referenced
    assignment or trial metadata (${trialSpec.Name|Namespace|Kind|
    APIVersion|Labels[k]|Annotations[k]}).  Missing assignment, illegal
    metadata or a count mismatch -> ``error`` and no text.
    ``trials``: (experiment, trial, namespace, assignments, labels map,
    annotations map); ``templates``: (experiment, template, kind,
    api_version, trial_parameters array<struct<name,reference>>)."""
    t = trials.join(small(templates), "experiment")
    amap = F.map_from_entries(F.col("assignments"))
    ref = lambda p: p["reference"]

    def resolve(p):
        key = _meta_key(ref(p))
        base, idx = _bracketed(key)
        v = (F.when(key == "", F.element_at(amap, ref(p)))
             .when(base == "Name", F.col("trial")).when(base == "Namespace", F.col("namespace"))
             .when(base == "Kind", F.col("kind")).when(base == "APIVersion", F.col("api_version"))
             .when(base == "Labels", F.element_at(F.col("labels"), idx))
             .when(base == "Annotations", F.element_at(F.col("annotations"), idx)))
        return F.struct(p["name"].alias("name"), v.alias("value"), (key == "").alias("plain"), ref(p).alias("reference"))

    t = t.withColumn("resolved", F.transform("trial_parameters", resolve))
    bad = F.filter("resolved", lambda r: r["value"].isNull())
    n_plain = F.size(F.filter("resolved", lambda r: r["plain"]))
    err = (F.when(F.size(bad) > 0, F.concat(F.lit("unresolved reference: "), F.element_at(bad, 1)["reference"]))
           .when(F.size("assignments") != n_plain,
                 F.concat(F.lit("assignment count "), F.size("assignments").cast("string"),
                          F.lit(" != trial parameter count "), n_plain.cast("string"))))
    text = F.aggregate("resolved", F.col("template"),
                       lambda s, r: F.replace(s, F.concat(F.lit("${trialParameters."), r["name"], F.lit("}")), r["value"]))
    return t.select("experiment", "trial", F.when(err.isNull(), text).alias("rendered"), err.alias("error"))
