import math
import random
from itertools import permutations

import numpy as np
import pytest
from helpers import values
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from churnkit.ml import explain, folds, matrix, metrics, select, train
from churnkit.plans import q_ml
from churnkit.plans.registry import QUERIES
from churnkit.schemas import LABEL, MODEL_INPUTS, NUMERIC_FEATURES

PARAMS = {"maxIter": 5, "stepSize": 0.3, "maxDepth": 3}


def auc_by_pairs(scored):
    pos = [s for s, y in scored if y]
    neg = [s for s, y in scored if not y]
    if not pos or not neg:
        return 0.5
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def ap_by_steps(scored):
    total = sum(y for _, y in scored)
    area, before = 0.0, 0
    for t in sorted({s for s, _ in scored}, reverse=True):
        hit = [y for s, y in scored if s >= t]
        area += (sum(hit) - before) / total * sum(hit) / len(hit)
        before = sum(hit)
    return area


@pytest.mark.parametrize("seed, levels", [(1, 5), (2, 50), (3, 100000)])
def test_auc_and_ap_match_their_definitions(spark, seed, levels):
    rnd = random.Random(seed)
    data = [(g, rnd.randrange(levels) / levels, int(rnd.random() < 0.3)) for g in (0, 1) for _ in range(150)]
    df = spark.createDataFrame(data, "g int, s double, y int")
    auc = dict(values(metrics.roc_auc(df, "s", "y", "g")))
    ap = dict(values(metrics.average_precision(df, "s", "y", "g")))
    for g in (0, 1):
        part = [(s, y) for h, s, y in data if h == g]
        assert auc[g] == pytest.approx(auc_by_pairs(part), abs=1e-6)
        assert ap[g] == pytest.approx(ap_by_steps(part), abs=1e-6)


def test_one_class_gives_the_neutral_values(rows):
    df = rows([(0.1, 0), (0.9, 0)], "s double, y int")
    assert metrics.roc_auc(df, "s", "y").first().roc_auc == 0.5
    assert metrics.average_precision(df, "s", "y").first().pr_auc == 0.0
    assert tuple(metrics.threshold_metrics(df, "s", "y", 0.95).first()) == (2, 0, 0.0, 0.0, 0.0)


def test_threshold_metrics_and_report(rows):
    df = rows([(0.4, 1), (0.39, 1), (0.8, 0), (0.9, 1), (0.1, 0)], "s double, y int")
    r = metrics.threshold_metrics(df, "s", "y", 0.4).first()
    assert (r.val_size, r.positives, r.precision, r.recall, r.f1) == (5, 3, 0.666667, 0.666667, 0.666667)
    lines = {r["row"]: r for r in metrics.classification_report(df, "s", "y", 0.4).collect()}
    assert set(lines) == {"no_churn", "churn", "accuracy", "macro avg", "weighted avg"}
    assert (lines["no_churn"].precision, lines["no_churn"].support) == (0.5, 2)
    assert lines["accuracy"].f1 == 0.6 and lines["macro avg"].recall == pytest.approx((0.5 + 2 / 3) / 2, abs=1e-6)


def test_pr_curve_ends_at_full_recall(rows):
    df = rows([(0.9, 1), (0.5, 0), (0.5, 1), (0.1, 0)], "s double, y int")
    got = [tuple(r) for r in metrics.pr_curve(df, "s", "y").orderBy(F.desc("threshold")).collect()]
    assert got == [(0.9, 1.0, 0.5, 0.5), (0.5, 0.666667, 1.0, 0.5), (0.1, 0.5, 1.0, 0.5)]


def test_folds_are_stratified_and_repeatable(spark):
    df = spark.range(203).withColumn("y", (F.col("id") % 9 == 0).cast("int"))
    a = folds.stratified_folds(df, "y", "id", 5, 42)
    sizes = {}
    for r in a.groupBy("y", "fold").count().collect():
        sizes.setdefault(r.y, []).append(r["count"])
    assert all(len(s) == 5 and max(s) - min(s) <= 1 for s in sizes.values())
    assert values(a) == values(folds.stratified_folds(df.repartition(7), "y", "id", 5, 42))
    assert values(a) != values(folds.stratified_folds(df, "y", "id", 5, 43))


def test_model_matrix_coerces(rows):
    schema = "company_id string, " + ", ".join(f"{c} string" for c in NUMERIC_FEATURES) + f", billing_cycle string, {LABEL} string"
    df = rows([("c1", *["2.5"] * 31, "bad", "annual", "1"), ("c2", *[None] * 32, None, None)], schema)
    got = {r.company_id: r for r in matrix.model_matrix(df).collect()}
    assert got["c1"][NUMERIC_FEATURES[0]] == 2.5 and got["c1"][NUMERIC_FEATURES[-1]] == 0.0
    assert (got["c1"].billing_cycle_annual, got["c2"].billing_cycle_annual, got["c2"][LABEL]) == (1.0, 0.0, 0)


def test_class_balance_guards_zero(rows):
    assert tuple(matrix.class_balance(rows([(0,), (0,)], f"{LABEL} int")).first()) == (0, 2, 2.0)


@pytest.fixture(scope="module")
def trained(spark, tmp_path_factory):
    rnd = random.Random(5)
    data = []
    for i in range(300):
        x = [round(rnd.random(), 3) for _ in MODEL_INPUTS]
        y = int(x[0] + 0.5 * x[3] - 0.4 * x[7] + rnd.random() * 0.2 > 0.75)
        data.append((f"c{i}", *x, y))
    schema = "company_id string, " + ", ".join(f"{c} double" for c in MODEL_INPUTS) + f", {LABEL} int"
    df = spark.createDataFrame(data, schema).persist()
    model = train.train_gbt(df, PARAMS)
    path = str(tmp_path_factory.mktemp("model"))
    return df, model, explain.node_table(model, path).persist(), path


def test_contributions_add_up_to_the_log_odds(trained):
    df, model, nodes, _ = trained
    raw = model.transform(matrix.with_vector(df)).withColumn("margin", vector_to_array("rawPrediction")[1])
    expected = {r.company_id: 2 * r.margin for r in raw.select("company_id", "margin").collect()}
    got = explain.contributions(train.probabilities(model, df), nodes, MODEL_INPUTS).collect()
    assert len(got) == df.count()
    for r in got:
        total = r.base_value + sum(r.contributions.values())
        assert total == pytest.approx(expected[r.company_id], abs=1e-6)
        assert 1 / (1 + math.exp(-total)) == pytest.approx(r.probability, abs=1e-6)


def orders_mean(paths, row):
    """Contributions by their definition: the mean gain of an input over all orders in which inputs become known."""

    def value(known):
        out = 0.0
        for v, path in paths:
            for feature, threshold, left, share in path:
                v = v * float((row[feature] <= threshold) == left) if feature in known else v * share
            out += v
        return out

    phi, orders = np.zeros(len(row)), list(permutations(range(len(row))))
    for order in orders:
        for i, feature in enumerate(order):
            phi[feature] += value(set(order[: i + 1])) - value(set(order[:i]))
    return phi / len(orders), value(set())


def test_contributions_match_all_orders_of_the_inputs():
    """Random trees of depth four on five inputs, some of which come up twice on a path."""
    rnd = random.Random(4)
    paths = []

    def grow(path, depth):
        if depth == 4 or (depth > 1 and rnd.random() < 0.2):
            paths.append((rnd.uniform(-2, 2), path))
            return
        feature, threshold, share = rnd.randrange(5), rnd.random(), rnd.uniform(0.1, 0.9)
        grow([*path, (feature, threshold, True, share)], depth + 1)
        grow([*path, (feature, threshold, False, 1 - share)], depth + 1)

    for _ in range(4):
        grow([], 0)
    paths.append((0.25, []))  # a tree that is one leaf
    x = np.array([[rnd.random() for _ in range(5)] for _ in range(12)])
    phi, base = explain.shapley(x, [explain.leaf_of(v, path) for v, path in paths])
    for i, row in enumerate(x):
        want, start = orders_mean(paths, row)
        assert phi[i] == pytest.approx(want) and base == pytest.approx(start)


@pytest.mark.parametrize("depth, limit, joints", [(4, 8, 6), (4, 1, 24), (6, 8, 48), (2, 8, 2)])
def test_leaves_of_half_a_tree_are_looked_up_together(monkeypatch, depth, limit, joints):
    """Three full trees; the sums over the leaves one by one are the same, also for missing values and those on a threshold."""
    rnd, paths = random.Random(5), []

    def grow(path):
        if len(path) == depth:
            paths.append((rnd.uniform(-2, 2), path))
            return
        feature, threshold, share = rnd.randrange(6), rnd.random(), rnd.uniform(0.1, 0.9)
        grow([*path, (feature, threshold, True, share)])
        grow([*path, (feature, threshold, False, 1 - share)])

    for _ in range(3):
        grow([])
    x = np.array([[rnd.choice([rnd.random(), float("nan"), paths[0][1][0][1], paths[-1][1][-1][1]]) for _ in range(6)] for _ in range(50)])
    leaves = [explain.leaf_of(v, path) for v, path in paths]
    want = np.zeros(x.shape)
    for leaf in leaves:
        for row, values in enumerate(x):
            passed = (1 << len(leaf.inputs)) - 1
            for place, feature, threshold, left in leaf.tests:
                if bool(values[feature] <= threshold) != left:
                    passed &= ~(1 << place)
            want[row, leaf.inputs] += leaf.table[:, passed]
    monkeypatch.setattr(explain, "JOINT_TESTS", limit)
    monkeypatch.setattr(explain, "BLOCK_ROWS", 16)
    assert len(explain.joined(leaves)) == joints
    phi, base = explain.shapley(x, leaves)
    assert phi == pytest.approx(want) and base == pytest.approx(sum(leaf.base for leaf in leaves))


def test_best_round_waits_for_patience():
    assert train.best_round([5, 4, 3, 3.5, 3.4], 50) == 3
    falling_late = [3.0] + [3.1] * 49 + [2.0]
    assert train.best_round(falling_late, 50) == 51
    assert train.best_round([3.0] + [3.1] * 50 + [2.0], 50) == 1
    assert train.best_round([2.0] * 80, 50) == 1
    assert train.best_round(list(range(300, 0, -1)), 50) == 300


def test_early_stopping_keeps_the_rounds_up_to_the_best(trained):
    df, *_ = trained
    inside, outside = df.filter(F.xxhash64("company_id") % 3 == 0), df.filter(F.xxhash64("company_id") % 3 != 0)
    full = train.train_gbt(outside, {**PARAMS, "maxIter": 30})
    held = matrix.with_vector(inside).select("features", F.lit(1.0).alias("weight"), F.col(LABEL).cast("double").alias("label"))
    losses = full.evaluateEachIteration(held)
    patient, rounds = train.train_until_no_gain(outside, inside, {**PARAMS, "maxIter": 30}, 30)
    assert rounds == patient.getNumTrees == int(np.argmin(losses)) + 1 and rounds > 1
    hasty, few = train.train_until_no_gain(outside, inside, {**PARAMS, "maxIter": 30}, 1)
    assert few == hasty.getNumTrees <= rounds
    assert patient.evaluateEachIteration(held) == pytest.approx(losses[:rounds])
    # A model cut off after k rounds is the model of k rounds.
    short = train.train_gbt(outside, {**PARAMS, "maxIter": 4})
    cut = train.first_rounds(full, 4)
    probability = [[r.probability for r in train.probabilities(m, inside).orderBy("company_id").collect()] for m in (short, cut)]
    assert probability[0] == pytest.approx(probability[1])


def test_score_rows(trained):
    df, model, _, path = trained
    got = train.score(model, df, "2024-05-31", "m", "3", path + "/again", top_k=5)
    assert got.columns == ["company_id", "prediction_date", "churn_probability", "risk_tier", "top_factors", "model_version",
                           "model_name", "predicted_churn", "actual_churn"]
    r = got.withColumn("n", F.size(F.from_json("top_factors", "map<string,double>"))).first()
    assert r.n <= 5 and 0 <= r.churn_probability <= 1 and r.churn_probability == round(r.churn_probability, 4)
    auc = metrics.roc_auc(got, "churn_probability", "actual_churn").first().roc_auc
    assert auc > 0.9


def test_importance_lists_every_input(trained):
    _, model, nodes, _ = trained
    got = train.feature_importance(model, nodes).collect()
    assert {r.feature for r in got} == set(MODEL_INPUTS)
    assert sum(r.importance_gain for r in got) == pytest.approx(1.0)
    assert sum(r.importance_split for r in got) == nodes.filter("left >= 0").count()


def test_cross_validation_has_a_row_per_fold_and_the_mean(trained):
    df = trained[0]
    got = {r.fold: r for r in train.cross_validate(df, {"maxIter": 3, "stepSize": 0.3, "maxDepth": 2}, 3).collect()}
    assert set(got) == {"0", "1", "2", "mean"}
    assert got["mean"].val_size == df.count()
    assert got["mean"].roc_auc == pytest.approx(sum(got[str(i)].roc_auc for i in range(3)) / 3, abs=1e-5)
    assert all(1 <= got[str(i)].rounds <= 3 for i in range(3))


def test_tasks_of_a_fit_do_not_grow_with_the_rows():
    assert train.fit_tasks(0, 12) == train.fit_tasks(20_000, 12) == 1 and train.fit_tasks(20_001, 12) == 2
    assert train.fit_tasks(900_000, 12) == train.fit_tasks(5_400_000, 12) == 12
    assert train.fit_tasks(60_000_000, 12) == 120  # then a task's share of the rows would no longer fit its memory


def test_a_fit_runs_in_one_even_wave(spark, trained, monkeypatch):
    sizes = []

    class Fitted:
        def __init__(self, **_):
            pass

        def fit(self, rows):
            sizes.extend(r["n"] for r in rows.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect())

    monkeypatch.setattr(train, "GBTClassifier", Fitted)
    monkeypatch.setattr(train, "TASK_ROWS", 2)
    df = trained[0].repartition(40)
    train.train_gbt(df)
    slots = spark.sparkContext.defaultParallelism
    assert len(sizes) <= slots and sum(sizes) == df.count() and max(sizes) - min(sizes) <= 40


@pytest.mark.parametrize("name", ["ml_train_score", "ml_cross_validate", "ml_importance", "ml_explain"])
def test_registered_models_train_in_full(spark, name, monkeypatch):
    class Asked(Exception):
        pass

    def asked(rows, params=None, k=train.FOLDS, **_):
        raise Asked({**train.DEFAULT_PARAMS, **(params or {})}, k)

    monkeypatch.setattr(q_ml, "_stored_matrix", lambda s: None)
    monkeypatch.setattr(train, "train_gbt", asked)
    monkeypatch.setattr(train, "cross_validate", asked)
    with pytest.raises(Asked) as found:
        QUERIES[name](spark, "")
    assert found.value.args == (train.DEFAULT_PARAMS, 5)


def test_champion(rows):
    metrics_ = rows([("m", "r1", "FINISHED", 0, 0.7), ("m", "r1", "FINISHED", 1, 0.8), ("m", "r2", "FINISHED", 0, 0.9), ("m", "r2", "FINISHED", 1, 0.5),
                     ("m", "r3", "RUNNING", 0, 0.99), ("n", "r4", "FINISHED", 0, 0.55)],
                    "model_name string, run_id string, status string, fold int, roc_auc double")
    versions = rows([("m", "r1", 4), ("m", "r2", 5), ("n", "r4", 1)], "model_name string, run_id string, version int")
    assert values(select.select_champion(metrics_, versions)) == [("m", "r1", 0.75, 4)]
    assert values(select.select_champion(metrics_, versions, run_id="r4")) == [("n", "r4", 0.55, 1)]


def test_no_qualifying_run_is_an_error(rows):
    runs = rows([("m", "r1", "FINISHED", 0, 0.55)], "model_name string, run_id string, status string, fold int, roc_auc double")
    versions = rows([("m", "r1", 1)], "model_name string, run_id string, version int")
    with pytest.raises(ValueError, match="0.6"):
        select.require_champion(runs, versions)
    assert select.require_champion(runs, versions, run_id="r1").first().version == 1


def test_publish_is_idempotent(rows):
    schema = "company_id string, prediction_date date, churn_probability double, risk_tier string, top_factors string, model_version string, model_name string"
    import datetime as dt

    d = dt.date(2024, 1, 1)
    target = rows([("c1", d, 0.1, "Low", "{}", "1", "m")], schema)
    scored = rows([("c1", d, 0.9, "High", '{"a":1.0}', "2", "m"), ("c2", d, 0.2, "Low", "{}", "2", "m")], schema)
    once = select.publish_predictions(target, scored)
    assert values(once) == values(select.publish_predictions(once, scored))
    assert tuple(select.published_check(once, d).first()) == (2, 1)
    assert values(select.top_risk(once, 1)) == [("c1", 0.9, "High", "a")]


def test_store_predictions_replaces_only_the_scored_day(rows, tmp_path):
    import datetime as dt

    from churnkit.sources import tables as io

    schema = "company_id string, prediction_date date, churn_probability double, risk_tier string, top_factors string, model_version string, model_name string"
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    old = rows([("c1", d1, 0.1, "Low", "{}", "1", "m"), ("c1", d2, 0.2, "Low", "{}", "1", "m"), ("c9", d2, 0.3, "Low", "{}", "1", "m")], schema)
    io.write_table(old, str(tmp_path), "gold", "agg_churn_predictions", ["prediction_date"])
    scored = rows([("c1", d2, 0.9, "High", "{}", "2", "m"), ("c2", d2, 0.8, "High", "{}", "2", "m")], schema)
    for _ in range(2):
        select.store_predictions(scored, str(tmp_path), d2)
    got = io.read_table(rows([], "a int").sparkSession, str(tmp_path), "gold", "agg_churn_predictions")
    assert values(got.select("company_id", "prediction_date", "churn_probability")) == [
        ("c1", d1, 0.1), ("c1", d2, 0.9), ("c2", d2, 0.8), ("c9", d2, 0.3)
    ]


def test_explanation_travels_with_the_task(tmp_path):
    """A worker that cannot import this package can still run it."""
    import os
    import subprocess
    import sys

    from pyspark import cloudpickle

    (tmp_path / "f.pkl").write_bytes(cloudpickle.dumps((explain.shapley, explain.leaf_of(2.0, []))))
    code = "import pickle, numpy; f, leaf = pickle.load(open('f.pkl', 'rb')); print(f(numpy.zeros((1, 2)), [leaf])[1])"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=60)
    assert done.stdout.strip() == "2.0", done.stderr
