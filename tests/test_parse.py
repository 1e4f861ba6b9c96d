"""Cases of the log parser."""

import pytest

from trialfold.functions.exprs import ZERO_TIME
from trialfold.operators import parse

#: A name, then its value in braces.
BRACES = r"(\w+) {(-?\d+\.\d+)}"


def _lines(spark, lines, metrics):
    rows = [("t1", i, l, metrics) for i, l in enumerate(lines)]
    return spark.createDataFrame(rows, "trial string, line_no long, line string, metrics array<string>")


def _parse(spark, lines, metrics, filters):
    rows = parse.parse_text_lines(_lines(spark, lines, metrics), filters)
    tl = spark.createDataFrame([("t1", metrics[0])], "trial string, objective string")
    out = parse.objective_fallback(rows, tl)
    return [(r.ts_raw, r.metric, r.value) for r in out.orderBy("seq", "sub").collect()]


def test_braces_filter(spark):
    lines = ["2022-11-30T23:59:01Z step 7: recall {0.625}, loss {-1.5}", "loss {2.75}", "2022-11-30T23:59:02Z recall {0.75}"]
    got = _parse(spark, lines, ["recall", "loss"], [BRACES])
    assert got == [("2022-11-30T23:59:01Z", "recall", "0.625"), ("2022-11-30T23:59:01Z", "loss", "-1.5"),
                   (ZERO_TIME, "loss", "2.75"), ("2022-11-30T23:59:02Z", "recall", "0.75")]


@pytest.mark.parametrize("value", ["", ".5", "6.", "- 6.5", "6,5"])
def test_unmatched_objective_is_unavailable(spark, value):
    line = f"2022-11-30T23:59:01Z recall {{{value}}}"
    assert _parse(spark, [line], ["recall", "loss"], [BRACES]) == [(ZERO_TIME, "recall", "unavailable")]


def test_broken_timestamp_keeps_value(spark):
    got = _parse(spark, ["2022-11-30 23:59:01 INFO accuracy=0.9"], ["accuracy"], None)
    assert got == [(ZERO_TIME, "accuracy", "0.9")]


def test_default_filter_forms(spark):
    got = _parse(spark, ["2022-11-30T23:59:01Z loss=0.5 recall=.25 Drift=-4e-07"], ["recall", "loss", "Drift"], None)
    assert [(m, v) for _, m, v in got] == [("loss", "0.5"), ("recall", ".25"), ("Drift", "-4e-07")]


def test_prefilter_drops_unrelated_lines(spark):
    df = parse.keyword_prefilter(_lines(spark, ["nothing here", "loss=1"], ["loss"]))
    assert [r.line for r in df.collect()] == ["loss=1"]


def test_re2_brace_rewrite():
    assert parse.re2_to_java("{a: (x)}") == r"\{a: (x)}"
    assert parse.re2_to_java(r"a{2,3}") == r"a{2,3}"


def _json(spark, lines, metrics, mode="failfast"):
    df = _lines(spark, lines, metrics)
    out = parse.parse_json_lines(df, mode=mode)
    return [(r.ts_raw, r.ts_nanos, r.metric, r.value) for r in out.orderBy("seq", "sub").collect()]


def test_json_timestamps(spark):
    times = ["1700000000.5", "1700000000.000125", '"2023-11-14T22:13:20.000000125Z"', None, '"noon"', "1700000000"]
    lines = [f'{{"timestamp": {t}, "loss": "{i}.5"}}' if t else f'{{"loss": "{i}.5"}}' for i, t in enumerate(times)]
    got = _json(spark, [*lines, '{"timestamp": 1700000000, "loss": 6.5}'], ["loss"])
    assert [v for *_, v in got] == [f"{i}.5" for i in range(6)]  # the number of the last line is no text (Q2)
    assert got[2][:2] == ("2023-11-14T22:13:20.000000125Z", 125) and got[5][:2] == ("2023-11-14T22:13:20Z", 0)
    assert [g[0] for g in got[3:5]] == [ZERO_TIME, ZERO_TIME]
    # digits after the point are read as nanoseconds (Q1)
    assert got[0][1] == 5 and got[1][1] == 125


def test_malformed_json_fails(spark):
    with pytest.raises(Exception):
        _json(spark, ['{"acc": "1"', '{"acc": "2"}'], ["acc"])
    assert len(_json(spark, ['{"acc": "1"', '{"acc": "2"}'], ["acc"], mode="permissive")) == 1


def test_filter_pattern_check(spark):
    df = spark.createDataFrame([("a=(x)",), (r"(\w+)=(\d+)",)], "filter string")
    assert [r.valid for r in parse.filter_pattern_check(df).collect()] == [False, True]


def test_objective_missing_replaces_log(spark):
    got = _parse(spark, ["2022-11-30T23:59:01Z loss=0.3"], ["accuracy", "loss"], None)
    assert got == [(ZERO_TIME, "accuracy", "unavailable")]


def test_filter_compile_check(spark):
    df = spark.createDataFrame([("(a(b)",), (r"(\w+)=(\d+)",)], "filter string")
    got = [(r.valid, r.reason) for r in parse.filter_pattern_check(df).collect()]
    assert got[0] == (False, "filter does not compile") and got[1] == (True, None)


def test_json_drop_file_mode(spark):
    rows = [("t1", 0, '{"acc": "1"}', ["acc"]), ("t1", 1, '{"acc": ', ["acc"]), ("t2", 0, '{"acc": "2"}', ["acc"])]
    df = spark.createDataFrame(rows, "trial string, line_no long, line string, metrics array<string>")
    assert [r.trial for r in parse.parse_json_lines(df, mode="drop_file").collect()] == ["t2"]


def test_each_experiment_has_its_own_filters(spark):
    rows = [("a", "t1", 0, "loss=1.5 recall {7}"), ("b", "t2", 0, "loss=1.5 recall {7}"), ("c", "t3", 0, "loss=1.5 recall {7}"),
            ("d", "t4", 0, "loss=1.5 recall {7}")]
    lines = spark.createDataFrame([(*r, ["loss", "recall"]) for r in rows], "experiment string, trial string, line_no long, line string, metrics array<string>")
    filters = spark.createDataFrame([("b", 0, r"(\w+) {(\d+)}"), ("b", 1, r"(\w+)=(\d)"), ("c", 0, "loss=(.*)"), ("c", 1, "([a-z"),
                                     ("d", 0, r"(?P<name>[(a-z]+)=(?P<value>\S+)")], "experiment string, pos int, pattern string")
    got = {}
    for r in parse.parse_by_filters(lines, filters).orderBy("trial", "sub").collect():
        got.setdefault(r.trial, []).append((r.metric, r.value))
    assert got == {"t1": [("loss", "1.5")], "t2": [("recall", "7"), ("loss", "1")], "t4": [("loss", "1.5")]}


def test_filters_fail_alone(spark):
    """Constructs that other engines refuse or stop on: each gives its rows or an error of its experiment, and the rest is read."""
    filters = [("flags", r"(\w+)=(?i)(\d+\.\d+)"), ("class", r"(\pL+)=(\d+\.\d+)"), ("posix", r"([[:alpha:]]+)=([[:digit:].]+)"), ("named", r"(?P<my_name>\w+)=(?P<v>[\d.]+)"),
               ("back", r"(?P<n>\w+)=(?P=n)?(\d+\.\d+)"), ("open", r"(\w+)=(\d+"), ("ahead", r"(\w+)(?==)(=)"), ("one", r"loss=(\d+)")]
    table = spark.createDataFrame([(e, 0, p) for e, p in filters], "experiment string, pos int, pattern string")
    faults = {r.experiment: r.error for r in parse.filter_verdicts(table).collect() if r.error}
    assert set(faults) == {"back", "open", "ahead", "one"} and "two capture groups" in faults["one"]
    lines = spark.createDataFrame([(e, f"t-{e}", 1, "epoch 1 loss=0.25 x", ["loss"]) for e, _ in [*filters, ("plain", "")]],
                                  "experiment string, trial string, line_no long, line string, metrics array<string>")
    got = {r.trial: r.value for r in parse.parse_by_filters(lines, table).collect()}
    assert got == {f"t-{e}": "0.25" for e in ("flags", "class", "posix", "named", "plain")}


def test_json_time_is_computed_in_stages(spark):
    """The plan of O18 doesn't repeat the parse of the line's map in every branch."""
    import __spark_entry__ as E

    plan = E.queries()["o18_json_timestamp"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("element_at(m#") + plan.count("map<string,variant>") <= 3, plan.count("map<string,variant>")
