"""Report shaping on reference fixtures (F9 architecture, F10 run config)."""

import json
import uuid

from trialfold.operators import report
from trialfold.session import checkpoint_dir
from trialfold.sources import files


def test_f9_architecture_graph(spark):
    arch = spark.createDataFrame([("e", "t", "[[27], [29, 0], [22, 1, 0], [13, 0, 0, 0]]")],
                                 "experiment string, trial string, architecture string")
    edges, nodes = report.architecture_graph(arch)
    got = sorted((r.src, r.dst) for r in edges.collect())
    assert got == sorted([(0, 1), (1, 2), (2, 3), (3, 4), (0, 3), (4, 5), (5, 6), (6, 7)])
    assert sorted((r.node, r.op_id) for r in nodes.collect()) == [(1, 27), (2, 29), (3, 22), (4, 13)]


def test_f10_run_config_route(spark):
    cfg = [{"method": "xgboost", "learning_rate_min": 0.2, "n_estimators_min": 1000, "datasets_from_pvc": False},
           {"method": "knn", "n_neighbors_min": 1},
           {"method": "svm", "c": 1}]
    p = f"{checkpoint_dir(spark)}/cfg-{uuid.uuid4().hex}"
    spark.createDataFrame([(json.dumps(cfg),)], "value string").write.text(p)
    got = sorted((r.method, r.key, r.value) for r in files.read_run_config(spark, p).collect())
    assert ("xgboost", "learning_rate_min", "0.2") in got and ("knn", "n_neighbors_min", "1") in got
    assert all(m != "svm" for m, _, _ in got) and all(k != "method" for _, k, _ in got)


def test_status_headline_goal_text(spark):
    v = spark.createDataFrame([("e", "Succeeded", "ExperimentGoalReached")], "experiment string, status string, reason string")
    e = spark.createDataFrame([("e", "accuracy", "maximize", 0.99)],
                              "experiment string, objective_metric string, objective_type string, goal double")
    r = report.status_headline(v, report.experiment_conditions(v), e).collect()[0]
    assert r.status_message == "Experiment has succeeded because Objective goal has reached"
    assert r.goal_text == "accuracy > 0.99"
