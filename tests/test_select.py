"""Ranks inside groups: radix select, quantiles, top-k and numbering, with one group of a third of all rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from trialfold.functions import select

SCHEMA = "g string, x double, id long"


def hot(n=6000):
    rnd = random.Random(2)
    rows = [("hot", rnd.choice([rnd.gauss(0, 1), rnd.gauss(0, 1e-9), float(rnd.randrange(5)), 1e300 * rnd.random()]), i) for i in range(n // 3)]
    rows += [(f"g{i % 40}", rnd.random(), i) for i in range(n // 3, n - 200)]
    rows += [("ties", 7.5, i) for i in range(n - 200, n - 3)]
    return rows + [("far", -math.inf, n - 3), ("far", 0.0, n - 2), ("far", math.inf, n - 1), ("nulls", None, n), ("nulls", 3.0, n + 1)]


@pytest.fixture(autouse=True, params=[20, 10**6], ids=["rounds", "direct"])
def direct(request, monkeypatch):
    """Every test with histogram rounds and range partitions, and with windows over small groups."""
    monkeypatch.setattr(select, "DIRECT", request.param)
    return request.param


@pytest.fixture(scope="module")
def rows():
    return hot()


def groups(rows):
    out = {}
    for g, x, i in rows:
        out.setdefault(g, []).append((x, i))
    return out


def test_kth_values(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    want = {}
    for g, xs in groups(rows).items():
        xs = sorted(x for x, _ in xs if x is not None)
        for k in {1, 2, (len(xs) + 1) // 2, len(xs)}:
            if k <= len(xs):
                want[g, k] = (xs[k - 1], sum(x < xs[k - 1] for x in xs), sum(x == xs[k - 1] for x in xs))
    asked = spark.createDataFrame([*want, ("hot", 10**6), ("hot", 0), ("nobody", 1)], "g string, k long")
    got = {(r["g"], r["k"]): (r["threshold"], r["below"], r["equal"]) for r in select.kth_values(df, ["g"], "x", asked).collect()}
    assert got == want


def test_long_values_beyond_the_digits_of_a_double(spark):
    xs = [2**62 + i for i in range(50)] + [-2**62 - i for i in range(50)]
    df = spark.createDataFrame([("a", x) for x in xs], "g string, x long")
    got = {r["k"]: r["threshold"] for r in select.kth_values(df, ["g"], "x", spark.createDataFrame([("a", k) for k in (1, 50, 51, 75, 100)], "g string, k long")).collect()}
    assert got == {k: sorted(xs)[k - 1] for k in (1, 50, 51, 75, 100)}


def test_quantiles_are_numpys(spark, rows):
    df = spark.createDataFrame([r for r in rows if r[0] != "far"], SCHEMA)
    asked = [(g, f) for g in ("hot", "g1", "ties", "nulls") for f in (0.0, 0.1, 0.25, 0.5, 0.9, 1.0)]
    got = {(r["g"], r["fraction"]): r["quantile"] for r in select.quantiles(df, ["g"], "x", spark.createDataFrame(asked, "g string, fraction double")).collect()}
    by = groups(rows)
    assert set(got) == set(asked)
    for g, f in asked:
        assert got[g, f] == pytest.approx(np.quantile([x for x, _ in by[g] if x is not None], f), rel=1e-12)


def test_smallest_of_hot_groups_and_ties(spark, rows):
    rows = [r for r in rows if r[1] is not None]
    ks = {"hot": 1500, "ties": 30, "g1": 5, "g2": 10**6, "far": 2, "g3": 0}
    df = spark.createDataFrame(rows, SCHEMA)
    k = F.coalesce(*[F.when(F.col("g") == g, F.lit(n)) for g, n in ks.items()], F.lit(3))
    got = {(r["g"], r["id"]): r["rank"] for r in select.smallest(df, ["g"], F.col("x"), F.col("id"), k).collect()}
    want = {(g, i): n + 1 for g, xs in groups(rows).items() for n, (_, i) in enumerate(sorted(xs)[:ks.get(g, 3)])}
    assert got == want


def test_numbering_spreads_a_hot_group(spark, rows, direct):
    rows = [r for r in rows if r[1] is not None]
    out = select.ranked_in_groups(spark.createDataFrame(rows, SCHEMA), ["g"], [F.col("x"), F.col("id")])
    got = {(r["g"], r["id"]): r["rank"] for r in out.collect()}
    assert got == {(g, i): n + 1 for g, xs in groups(rows).items() for n, (_, i) in enumerate(sorted(xs))}
    if direct > len(rows):
        return
    # the plan numbers inside (group, range partition), never over a whole group
    plan = out._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.split("\n") if "row_number()" in line and "windowspecdefinition" in line]
    assert windows and all("_part" in line.split("windowspecdefinition")[1] for line in windows)
