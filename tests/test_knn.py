"""The exact kNN equals brute force, and opens a falling share of the pairs."""

import random
from pathlib import Path
from urllib.parse import urlparse

import numpy as np
from pyspark.sql import functions as F

from trialfold.operators import knn
from trialfold.session import checkpoint_dir

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(refs, q, k=5):
    d = sorted(((sum((a - b) ** 2 for a, b in zip(q[1], r[1])) ** 0.5, r[0], r[2]) for r in refs))[:k]
    votes = {}
    for _, _, lab in d:
        votes[lab] = votes.get(lab, 0) + 1
    return min(votes, key=lambda lab: (-votes[lab], lab))


def predicted(spark, refs, qs, **more):
    return {r.vec_id: r.prediction for r in knn.knn_classify(spark.createDataFrame(refs, SCHEMA), spark.createDataFrame(qs, SCHEMA), **more).collect()}


def test_knn_equals_brute_force(spark):
    rnd = random.Random(3)
    pts = [(i, [rnd.random() for _ in range(8)], rnd.randrange(4)) for i in range(300)]
    refs, qs = pts[:240], pts[240:]
    want = {q[0]: brute(refs, q) for q in qs}
    assert predicted(spark, refs, qs) == want
    # several rounds, small blocks
    assert predicted(spark, refs, qs, first=10, chunk=7, qblock=9) == want


def test_equal_distances_take_the_smaller_id(spark):
    """Points on a small grid: many references at one distance, repeated points, pivots that coincide."""
    rnd = random.Random(5)
    pts = [(i, [float(rnd.randrange(4)), float(rnd.randrange(4))], rnd.randrange(3)) for i in range(260)]
    refs, qs = pts[:200], pts[200:]
    assert predicted(spark, refs, qs, first=8) == {q[0]: brute(refs, q) for q in qs}


def test_fewer_references_than_k_and_none(spark):
    refs = [(1, [0.0, 0.0], 2), (2, [1.0, 0.0], 1)]
    qs = [(5, [0.4, 0.0], 0)]
    assert predicted(spark, refs, qs) == {5: 1}
    assert predicted(spark, [], qs) == {}
    assert predicted(spark, refs, []) == {}


def test_the_share_of_evaluated_pairs_falls(spark):
    rng = np.random.default_rng(1)
    shares = []
    for n in (500, 2000, 8000):
        centres = rng.normal(0, 10, (40, 6))
        x = centres[rng.integers(0, 40, n)] + rng.normal(0, 0.5, (n, 6))
        refs = [(i, x[i].tolist(), i % 3) for i in range(n)]
        qs = [(n + i, (centres[i % 40] + rng.normal(0, 0.5, 6)).tolist(), 0) for i in range(80)]
        pairs = []
        got = predicted(spark, refs, qs, first=64, watch=lambda opened: pairs.append(opened.agg(F.sum("n")).first()[0]))
        assert got == {q[0]: brute(refs, q) for q in qs}
        shares.append(sum(pairs) / (n * len(qs)))
    assert shares[0] > shares[1] > shares[2] and shares[2] < 0.15, shares


def test_sifted_pairs_are_those_of_exact_distances():
    rng = np.random.default_rng(4)
    for scale, shift in ((1.0, 0.0), (1e-6, 1e3), (1e6, 0.0)):
        a, b = rng.integers(0, 3, (30, 5)) * scale + shift, rng.integers(0, 3, (90, 5)) * scale + shift  # many ties
        exact = knn.distances(a, b)
        for k, most in ((1, np.inf), (5, np.inf), (90, np.inf), (5, np.median(exact))):
            qi, ri, dist = knn.nearest_pairs(a, b, np.full(len(a), most), k)
            assert (dist == exact[qi, ri]).all()
            kth = np.minimum(np.sort(exact, axis=1)[:, k - 1], most)
            assert set(zip(*np.nonzero(exact <= kth[:, None]))) <= set(zip(qi, ri))
    unit = rng.normal(0, 1, (2000, 16))
    qi, _, _ = knn.nearest_pairs(unit[:50], unit, np.full(50, np.inf), 5)
    assert len(qi) < 50 * 10  # the rest is never computed exactly


def test_what_is_written_follows_the_input_not_the_pairs(spark):
    """Vectors without structure, so that every query opens nearly every leaf."""
    rng = np.random.default_rng(8)
    x = rng.normal(0, 1, (2400, 32))
    refs, qs = ([(i, x[i].tolist(), i % 3) for i in some] for some in (range(2000), range(2000, 2400)))
    kept = Path(urlparse(checkpoint_dir(spark)).path)
    before = {p for p in kept.rglob("*") if p.is_file()}
    pairs = []
    got = predicted(spark, refs, qs, first=64, watch=lambda opened: pairs.append(opened.agg(F.sum("n")).first()[0]))
    written = sum(p.stat().st_size for p in {*kept.rglob("*")} - before if p.is_file())
    assert got == {q[0]: brute(refs, q) for q in qs}
    assert sum(pairs) > 0.9 * len(refs) * len(qs)
    assert x.nbytes < written < 3 * x.nbytes


def test_single_precision_columns_are_as_exact(spark):
    """Rows too far from the origin for single numbers to tell them apart, and near ones; ids and rows that come twice."""
    rng = np.random.default_rng(9)
    for shift in (0.0, 1000.0):
        x = (rng.integers(0, 4, (260, 3)) / 8 + shift).astype(np.float32).astype(float)
        refs, qs = ([(i, x[i].tolist(), i % 4) for i in some] for some in (range(200), range(200, 260)))
        schema = SCHEMA.replace("double", "float")
        got = knn.knn_classify(spark.createDataFrame(refs, schema), spark.createDataFrame(qs + qs[:5], schema), first=16, chunk=50, qblock=20).collect()
        # a query that comes twice has each of its neighbours twice
        assert {r.vec_id: r.prediction for r in got if r.vec_id >= 205} == {q[0]: brute(refs, q) for q in qs[5:]}
        twice = spark.createDataFrame(qs[:5] * 2, schema).select(F.col("vec_id").alias("qid"), F.col("embedding").alias("qv"))
        top = knn.neighbours(spark.createDataFrame(refs, schema).select(F.col("vec_id").alias("rid"), F.col("embedding").alias("v"), "label"), twice, 4).collect()
        for q in qs[:5]:
            order = sorted((sum((a - b) ** 2 for a, b in zip(q[1], r[1])), r[0]) for r in refs)
            assert sorted(r.rid for r in top if r.qid == q[0]) == sorted(2 * [order[0][1], order[1][1]])


def test_missing_ids_labels_and_vectors(spark):
    refs = [(1, [0.0], 2), (2, [1.0], None), (None, [2.0], 1), (3, [2.0], 1), (0, None, 5), (9, [None], 6)]
    qs = [(7, [1.9]), (None, [0.2]), (8, None)]
    rows, asked = "rid long, v array<double>, label int", "qid long, qv array<double>"
    got = knn.neighbours(spark.createDataFrame(refs, rows), spark.createDataFrame(qs, asked), 2).collect()
    assert {(r.qid, r.rid, r.label) for r in got} == {(7, 3, 1), (7, None, 1), (None, 1, 2), (None, 2, None), (8, 0, 5), (8, 1, 2)}
    got = knn.neighbours(spark.createDataFrame(refs[3:], rows), spark.createDataFrame(qs, asked), 3).collect()
    assert len(got) == 9 and {(r.rid, r.dist is None) for r in got if r.qid == 7} == {(3, False), (0, True), (9, True)}
    votes = spark.createDataFrame([(1, [0.0], None), (2, [0.1], None), (3, [0.2], 4)], SCHEMA)
    assert [r.prediction for r in knn.knn_classify(votes, spark.createDataFrame([(5, [0.0], 0)], SCHEMA), k=3).collect()] == [4]
