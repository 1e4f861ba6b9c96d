"""Search-space properties and matching/template rules."""

import numpy as np
from pyspark.sql import functions as F

from trialfold.operators import space

SPECS = [("e", 0, "layers", "int", "2", "9", None, None), ("e", 1, "act", "categorical", None, None, None, ["relu", "tanh"]),
         ("e", 2, "width", "discrete", None, None, None, ["16", "64", "32", "8"]), ("e", 3, "decay", "double", "-0.25", "0.75", None, None)]
SCHEMA = "experiment string, pos int, name string, type string, min string, max string, step string, list array<string>"


def _specs(spark):
    return spark.createDataFrame(SPECS, SCHEMA)


def _counts(spark, n):
    return spark.createDataFrame([("e", n)], "experiment string, n int")


def test_uniform_samples_inside_space(spark):
    r = space.uniform_sample(_specs(spark), _counts(spark, 50)).collect()
    assert len(r) == 50 * 4
    for x in r:
        _, _, _, _, lo, hi, _, values = next(spec for spec in SPECS if spec[2] == x.name)
        if values:
            assert x.value_text in values
        else:
            assert float(lo) <= x.value_num <= float(hi)
        assert x.name != "layers" or float(x.value_text) == x.value_num


def test_library_samples_inside_space(spark):
    specs = spark.createDataFrame([("e", 0, "lr", "double", "0.01", "0.5", "0.01", None),
                                   ("e", 1, "n", "int", "10", "100", "5", None)], SCHEMA)
    for lib in space.LIBRARY_MODES:
        for x in space.library_sample(specs, _counts(spark, 40), lib).collect():
            lo, hi = (0.01, 0.5) if x.name == "lr" else (10, 100)
            assert lo - 1e-9 <= x.value_num <= hi + 1e-9, (lib, x)


def test_grid_size_is_product(spark):
    specs = spark.createDataFrame([("e", 0, "a", "int", "1", "5", "2", None),
                                   ("e", 1, "b", "double", "0.1", "0.35", "0.1", None),
                                   ("e", 2, "c", "categorical", None, None, None, ["x", "y"])], SCHEMA)
    ax = space.grid_axes(specs)
    sizes = {r.name: r.size for r in ax.collect()}
    assert sizes == {"a": 3, "b": 3, "c": 2}
    g = space.grid_product(ax)
    assert g.select("combo").distinct().count() == 18
    first = sorted((r.pos, r.value_text or round(r.value_num, 6)) for r in g.filter("combo = 1").collect())
    assert first == [(0, "1"), (1, 0.1), (2, "y")]  # last axis varies fastest


def test_wide_axes_and_products_stop_no_other_experiment(spark):
    """Axes of 3e9 and 1e10 values, products beyond a long, steps of zero, huge bounds: sizes, single values and errors."""
    specs = spark.createDataFrame([
        ("int", 0, "a", "int", "1", "3000000000", "", None), ("dbl", 0, "a", "double", "0", "1e10", "1", None),
        *[("four", i, f"p{i}", "int", "1", "1000000", "1", None) for i in range(4)],
        ("zero", 0, "a", "int", "1", "5", "0", None), ("zero", 1, "b", "double", "0", "1", "0", None),
        ("ends", 0, "a", "int", "-9223372036854775808", "9223372036854775807", "1", None), ("huge", 0, "a", "double", "-1e308", "1e308", "1e-300", None),
        ("down", 0, "a", "int", "5", "1", "1", None), ("ok", 0, "a", "int", "1", "3", "1", None), ("ok", 1, "b", "categorical", None, None, None, ["x", "y"])], SCHEMA)
    ax = space.grid_axes(specs)
    got = {(r.experiment, r.pos): (r.size, r.error is not None) for r in ax.collect()}
    assert got[("int", 0)] == (3_000_000_000, False) and got[("dbl", 0)] == (10_000_000_001, False)
    assert got[("zero", 0)] == got[("zero", 1)] == (0, True) and got[("down", 0)] == (0, False)
    assert got[("ends", 0)] == got[("huge", 0)] == (space.LARGEST, False)
    e = spark.createDataFrame([(x, 2) for x in ("int", "dbl", "four", "zero", "ends", "huge", "down", "ok")], "experiment string, max_trial_count long")
    sizes = {r.experiment: (r.grid_size, r.valid) for r in space.grid_size(ax, e).collect()}
    assert sizes["four"] == (space.LARGEST, True) and sizes["ok"] == (6, True) and not sizes["zero"][1] and not sizes["down"][1]
    # single values are made without the axis
    far = ax.filter("experiment in ('int', 'dbl')").select("experiment", space.axis_value(F.lit(2_999_999_999).cast("long")).alias("v"))
    assert {r.experiment: (r.v.num, r.v.text) for r in far.collect()} == {"int": (3e9, "3000000000"), "dbl": (2999999999.0, None)}
    # listings and products of the others go on beside them
    some = ax.filter("experiment in ('ok', 'zero', 'down')")
    assert [(r.idx, r.text) for r in space.axis_rows(some.filter("pos = 1")).orderBy("idx").collect()] == [(0, "x"), (1, "y")]
    assert space.grid_product(some).count() == 12
    first = space.axis_rows(ax.filter("experiment = 'int'")).limit(3).collect()
    assert len(first) == 3


def test_double_axis_needs_step(spark):
    specs = spark.createDataFrame([("e", 0, "b", "double", "0.1", "0.3", None, None)], SCHEMA)
    assert space.axis_values(specs).collect()[0].error is not None


def test_sobol_first_points(spark):
    specs = spark.createDataFrame([("e", 0, "x", "double", "0", "1", None, None),
                                   ("e", 1, "y", "double", "0", "1", None, None)], SCHEMA)
    pts = {(r.sample, r.name): r.u for r in space.sobol_sample(specs, _counts(spark, 4)).collect()}
    assert [pts[(i, "x")] for i in range(4)] == [0.0, 0.5, 0.75, 0.25]
    assert [pts[(i, "y")] for i in range(4)] == [0.0, 0.5, 0.25, 0.75]


def test_assignment_key_and_fifo(spark):
    df = spark.createDataFrame([("e", "s1", 1, [("b", "2"), ("a", "1")]), ("e", "s2", 2, [("a", "1"), ("b", "2")])],
                               "experiment string, id string, order int, a array<struct<name:string,value:string>>")
    k = df.select("experiment", "id", "order", space.assignment_key(F.col("a")).alias("key"))
    assert {r.key for r in k.collect()} == {"a:1,b:2"}
    fin = k.select("experiment", F.lit("t1").alias("trial"), "order", "key").filter("order = 2")
    assert space.fifo_match(k, fin).collect()[0].suggestion == "s1"


def test_template_substitution(spark):
    trials = spark.createDataFrame(
        [("e", "t1", "ns", [("lr", "0.1")], {"team": "x"}, {})],
        "experiment string, trial string, namespace string, assignments array<struct<name:string,value:string>>, "
        "labels map<string,string>, annotations map<string,string>")
    tmpl = spark.createDataFrame(
        [("e", "--lr=${trialParameters.lr} n=${trialParameters.n} t=${trialParameters.t}", "Job", "batch/v1",
          [("lr", "lr"), ("n", "${trialSpec.Name}"), ("t", "${trialSpec.Labels[team]}")])],
        "experiment string, template string, kind string, api_version string, "
        "trial_parameters array<struct<name:string,reference:string>>")
    r = space.substitute_template(trials, tmpl).collect()[0]
    assert r.rendered == "--lr=0.1 n=t1 t=x" and r.error is None


def test_template_reference_forms(spark):
    refs = ["lr", "${trialSpec.Kind}", "${trialSpec.Annotations[a/b]}", "${trialSpec.Labels}", "${trialSpec.Color}", "${trialSpec.Name"]
    trials = spark.createDataFrame([(f"e{i}", "t1", "ns", [("lr", "0.1")] if r == "lr" else [], {"team": "x"}, {"a/b": "y"}) for i, r in enumerate(refs)],
                                   "experiment string, trial string, namespace string, assignments array<struct<name:string,value:string>>, "
                                   "labels map<string,string>, annotations map<string,string>")
    tmpl = spark.createDataFrame([(f"e{i}", "<${trialParameters.p}>", "Job", "batch/v1", [("p", r)]) for i, r in enumerate(refs)],
                                 "experiment string, template string, kind string, api_version string, "
                                 "trial_parameters array<struct<name:string,reference:string>>")
    got = {r.experiment: r.rendered for r in space.substitute_template(trials, tmpl).collect()}
    assert got == {"e0": "<0.1>", "e1": "<Job>", "e2": "<y>", "e3": None, "e4": None, "e5": None}


def test_sobol_dimensions_are_balanced_and_paired():
    """Every dimension has one of the first 64 points in each 64th, and the
    first ones fill the boxes of the plane two by two."""
    v = np.array(space.sobol_directions(40), dtype=object)
    points = np.zeros((40, 1024), dtype=np.int64)
    for n in range(1024):
        gray, x = n ^ n >> 1, np.zeros(40, dtype=object)
        for k in range(10):
            if gray >> k & 1:
                x ^= v[:, k]
        points[:, n] = x
    for row in points:
        assert sorted(row[:64] >> 26) == list(range(64))
        assert sorted(row >> 22) == list(range(1024))
    for a, b in [(0, 1), (0, 2), (1, 2), (2, 3), (3, 4)]:  # 1024 points over 8 x 8 boxes
        assert set(np.bincount((points[a] >> 29) * 8 + (points[b] >> 29), minlength=64)) == {16}
    assert len({tuple(r) for r in v}) == 40


def test_sobol_covers_every_parameter(spark):
    rows = [("e", i, f"p{i}", "double", "0", "1", None, None) for i in range(5)]
    rows += [("e", 5, "kind", "categorical", None, None, None, ["a", "b", "c"]), ("e", 6, "n", "int", "1", "9", "2", None),
             ("none", 0, "x", "double", "0", "1", None, None)]
    counts = spark.createDataFrame([("e", 16), ("none", 0)], "experiment string, n int")
    got = space.sobol_sample(spark.createDataFrame(rows, SCHEMA), counts).collect()
    assert len(got) == 16 * 7
    assert {r.value_text for r in got if r.name == "kind"} == {"a", "b", "c"}
    assert {r.value_num for r in got if r.name == "n"} <= {1.0, 3.0, 5.0, 7.0, 9.0}
    assert len({(r.name, r.u) for r in got if r.name == "p4"}) == 16
