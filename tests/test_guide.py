"""Guidance operators: hyperband formulas, TPE scoring, lineage."""

import math
import random

from pyspark.sql import functions as F

from trialfold.operators import guide


def test_hyperband_schedule_matches_formulas(spark):
    e = spark.createDataFrame([("e", 3, 27), ("f", 2, 18)], "experiment string, hb_eta int, hb_r int")
    got = {(r.experiment, r.s, r.i): (r.n, r.n_i, r.keep, r.r_i) for r in guide.hyperband_schedule(e).collect()}
    for name, eta, R in [("e", 3, 27), ("f", 2, 18)]:
        s_max = max(s for s in range(64) if eta ** s <= R)
        for s in range(s_max, -1, -1):
            n = int(math.ceil(float(s_max + 1) * (float(eta ** s) / float(s + 1))))
            r = R * eta ** (-s)
            for i in range(s + 1):
                n_i = math.ceil(n * eta ** (-i))
                assert got[(name, s, i)] == (n, n_i, int(math.ceil(n_i / eta)), int(r * eta ** i))


def test_tpe_prefers_the_good_region(spark):
    trials = [("e", i, 0, 0.05 + 0.01 * i, 1.0) for i in range(5)] + [("e", 10 + i, 0, 0.8 + 0.02 * i, 0.0) for i in range(10)]
    tr = spark.createDataFrame(trials, "experiment string, id long, dim int, x double, y double")
    cand = spark.createDataFrame([("e", 1, 0, 0.07), ("e", 2, 0, 0.85), ("e", 3, 0, 0.5)],
                                 "experiment string, id long, dim int, x double")
    best = guide.tpe_scores(cand, tr, gamma=0.25, top=1).collect()
    assert [r.candidate for r in best] == [1]


def test_lineage_pointer_jumping(spark):
    pop = spark.createDataFrame([("a", None), ("b", "a"), ("c", "b"), ("d", "c"), ("x", None)], "trial string, parent string")
    got = {r.trial: (r.root, r.depth) for r in guide.lineage_roots(pop).collect()}
    assert got == {"a": ("a", 0), "b": ("a", 1), "c": ("a", 2), "d": ("a", 3), "x": ("x", 0)}


def test_lineage_of_a_long_chain(spark):
    pop = spark.createDataFrame([(f"t{i}", f"t{i - 1}" if i else None) for i in range(100)], "trial string, parent string")
    got = {r.trial: (r.root, r.depth) for r in guide.lineage_roots(pop).collect()}
    assert got == {f"t{i}": ("t0", i) for i in range(100)}


def test_stop_rules_against_plain_python(spark):
    """One pass over the log gives what walking it row by row gives."""
    rng = random.Random(5)
    log = [(f"t{i % 7}", i, None, rng.choice("ab"), str(rng.randint(0, 9))) for i in range(400)]
    rules = [("e", 0, "a", "8", "greater", 4), ("e", 1, "b", "3", "less", 1), ("e", 2, "b", "9", "equal", 0)]
    obs = spark.createDataFrame(log, "trial string, seq long, ts timestamp, metric string, value string")
    trials = spark.createDataFrame([(f"t{i}", "e") for i in range(8)], "trial string, experiment string")
    r = spark.createDataFrame(rules, "experiment string, rule int, metric string, rule_value string, comparison string, start_step int")
    want = {}
    for t in (f"t{i}" for i in range(8)):
        firsts = []
        for _, _, metric, value, how, start in rules:
            rows = [(seq, int(v)) for tr, seq, _, m, v in log if tr == t and m == metric][max(start, 1) - 1:]
            test = {"greater": lambda x: x > int(value), "less": lambda x: x < int(value), "equal": lambda x: x == int(value)}[how]
            firsts.append(next((seq for seq, x in rows if test(x)), None))
        want[t] = None if None in firsts else max(firsts)
    got = {x.trial: (x.stop_seq if x.stopped else None) for x in guide.evaluate_stop_rules(obs, trials, r, salts=3).collect()}
    assert got == want and any(v is not None for v in got.values())
