"""Applying, combining and training sparse linear models."""

import hashlib
import math
import random

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from brindle.operators import classify, training
from brindle.sources import readers, sinks

INSTANCES = "doc_id string, label string, features array<int>"
MODEL = "model_id string, feature int, weight double"


@pytest.fixture(scope="module")
def instances(spark):
    data = [
        ("a", "spam", [1, 1, 2]),  # repeats count
        ("b", "ham", [9]),  # no weight in any model
        ("c", "ham", []),  # no feature at all
        ("d", "spam", [3, 4]),  # cancels to exactly 0 in x
        ("e", "ham", [2]),
    ]
    return spark.createDataFrame(data, INSTANCES)


@pytest.fixture(scope="module")
def model(spark):
    weights = {"x": {1: 0.5, 2: -0.25, 3: 1.0, 4: -1.0}, "y": {1: -1.0, 2: 2.0}, "z": {3: 0.125}}
    return spark.createDataFrame([(m, f, w) for m, ws in weights.items() for f, w in ws.items()], MODEL)


def test_apply(instances, model):
    assert rows(classify.apply_model(instances, model, "x")) == [
        ("a", "spam", 0.75, "spam"),
        ("b", "ham", 0.0, "ham"),
        ("c", "ham", 0.0, "ham"),
        ("d", "spam", 0.0, "ham"),
        ("e", "ham", -0.25, "ham"),
    ]


def test_ensembles(instances, model):
    ids = ["x", "y", "z"]
    average = {r.doc_id: (r.score, r.predicted) for r in classify.apply_ensemble(instances, model, ids, "average").collect()}
    assert average["a"] == ((0.75 + 0.0 + 0.0) / 3, "spam")
    assert average["d"] == (0.125 / 3, "spam")
    assert average["c"] == (0.0, "ham")
    vote = {r.doc_id: (r.score, r.predicted) for r in classify.apply_ensemble(instances, model, ids, "vote").collect()}
    assert vote == {"a": (-1.0, "ham"), "b": (-3.0, "ham"), "c": (-3.0, "ham"), "d": (-1.0, "ham"), "e": (-1.0, "ham")}


def test_ensemble_of_one_model_is_that_model(instances, model):
    single = classify.apply_model(instances, model, "x")
    assert rows(classify.apply_ensemble(instances, model, ["x"], "average")) == rows(single)
    voted = classify.apply_ensemble(instances, model, ["x"], "vote")
    assert rows(voted, "doc_id", "predicted") == rows(single, "doc_id", "predicted")


@pytest.mark.parametrize("method", ["mean", "", "average vote"])
def test_unknown_method(instances, model, method):
    with pytest.raises(ValueError):
        classify.apply_ensemble(instances, model, ["x"], method)


def sequential(data, delta=0.002):
    weights = {}
    for label, features in data:
        score = sum(weights.get(f, 0.0) for f in features)
        p = 1 / (1 + math.exp(-score))
        for f in features:
            weights[f] = weights.get(f, 0.0) + ((label == "spam") - p) * delta
    return weights


def training_set(n=400, seed=2):
    rng = random.Random(seed)
    # Feature 0 is on most instances and 1 on a third.
    return [
        (i, rng.choice(["spam", "ham"]), [0] * (i % 3 > 0) + [1] * (i % 3 == 0) + [rng.randrange(2, 40) for _ in range(6)])
        for i in range(n)
    ]


@pytest.fixture(scope="module")
def numbered(spark):
    data = [(f"g{i % 2}", i, label, features) for i, label, features in training_set()]
    return spark.createDataFrame(data, "model_id string, doc_id bigint, label string, features array<int>").repartition(5)


def weights_of(model):
    found = {}
    for r in model.collect():
        found.setdefault(r.model_id, {})[r.feature] = r.weight
    return found


def close(got, expected):
    assert got.keys() == expected.keys()
    assert all(math.isclose(got[k], expected[k], abs_tol=1e-12) for k in expected)


def position(key, seed):
    return int(hashlib.md5(f"{seed}:{key}".encode()).hexdigest()[:8], 16)


def in_parts(data, seed, batches, delta=0.002):
    """One pass over (id, label, features) in parts, each scored with the weights before it."""
    weights = {}
    for part in range(batches):
        change = {}
        for i, label, features in data:
            if position(i, seed) % batches == part:
                p = 1 / (1 + math.exp(-sum(weights.get(f, 0.0) for f in features)))
                for f in features:
                    change[f] = change.get(f, 0.0) + ((label == "spam") - p) * delta
        for f, c in change.items():
            weights[f] = weights.get(f, 0.0) + c
    return weights


@pytest.mark.parametrize("seed, batches", [(0, 8), (4, 3)])
def test_pass_in_parts(numbered, seed, batches):
    found = weights_of(training.train_minibatch(numbered, seed=seed, batches=batches))
    for group in (0, 1):
        close(found[f"g{group}"], in_parts([row for row in training_set() if row[0] % 2 == group], seed, batches))


def test_pass_in_parts_keeps_null_ids_and_takes_empty_tables(spark, numbered):
    data = [("m", None, "spam", [1]), ("m", None, "ham", [2, 2]), ("m", 1, "spam", []), ("m", 2, "ham", None)]
    frame = spark.createDataFrame(data, numbered.schema)
    close(weights_of(training.train_minibatch(frame))["m"], {1: 0.001, 2: -0.002})
    assert training.train_minibatch(frame.limit(0)).count() == 0


def test_plans_do_not_grow_with_the_steps(spark, numbered):
    def joins(df):
        return plan(df, "simple").count("Join")

    assert joins(training.train_minibatch(numbered, batches=3)) == joins(training.train_minibatch(numbered, batches=6))
    instances = numbered.drop("model_id")
    assert joins(training.train_batch(instances, 2)) == joins(training.train_batch(instances, 5))


def test_random_order(numbered):
    ids = [r.doc_id for r in training.in_random_order(numbered, "doc_id", 4).collect()]
    assert ids == sorted(range(400), key=lambda i: (position(i, 4), i))


def test_sequential_learner(numbered):
    found = weights_of(training.train_sgd(numbered))
    for group in (0, 1):
        close(found[f"g{group}"], sequential([(y, f) for i, y, f in training_set() if i % 2 == group]))
    shuffled = weights_of(training.train_sgd(numbered, shuffle_seed=4))
    order = sorted(training_set(), key=lambda row: position(row[0], 4))
    close(shuffled["g0"], sequential([(y, f) for i, y, f in order if i % 2 == 0]))


@pytest.mark.parametrize("shards", [1, 7])
def test_mixed_training_averages_sequential_shards(numbered, shards):
    """Two models in one job, each shard against a plain sequential pass."""
    found = weights_of(training.train_mixed(numbered, shards, seed=4))
    for group in (0, 1):
        data = sorted((position(i, 4), i, y, f) for i, y, f in training_set() if i % 2 == group)
        expected = {}
        for shard in range(shards):
            own = [(y, f) for p, _, y, f in data if p % shards == shard]
            for feature, weight in sequential(own).items():
                expected[feature] = expected.get(feature, 0.0) + weight * len(own) / len(data)
        close(found[f"g{group}"], expected)


def test_mixed_training_of_odd_rows(spark):
    data = [("m", None, "spam", [1, None]), ("m", 3, "ham", None), ("m", 4, "ham", []), ("n", 5, "spam", [2]), ("o", 6, "ham", [])]
    table = spark.createDataFrame(data, "model_id string, doc_id bigint, label string, features array<int>")
    half = training.DELTA / 2
    assert rows(training.train_mixed(table, 4)) == [("m", 1, pytest.approx(half / 3)), ("n", 2, pytest.approx(half))]
    assert training.train_mixed(table.limit(0)).count() == 0


def test_sequential_learner_refuses_a_larger_set(numbered):
    assert training.train_sgd(numbered, max_rows=200).count() > 0
    with pytest.raises(Exception, match="more than 199 labelled rows"):
        training.train_sgd(numbered, max_rows=199).collect()


@pytest.mark.parametrize("epochs", [1, 7])
def test_batch_training(spark, epochs):
    data = training_set(120)
    weights = {f: 0.0 for _, _, features in data for f in features}
    for _ in range(epochs):
        change = dict.fromkeys(weights, 0.0)
        for _, label, features in data:
            p = 1 / (1 + math.exp(-sum(weights[f] for f in features)))
            for f in features:
                change[f] += ((label == "spam") - p) * training.DELTA
        weights = {f: w + change[f] for f, w in weights.items()}
    frame = spark.createDataFrame([(str(i), y, f) for i, y, f in data], INSTANCES)
    close(weights_of(training.train_batch(frame, epochs))["model"], weights)


def test_text_forms(spark, instances, model, tmp_path):
    path = tmp_path / "instances.txt"
    path.write_text("a spam 1 1 2\n b  ham\t9 \nc ham\n")
    assert rows(readers.labelled_instances(spark, str(path))) == [
        ("a", "spam", [1, 1, 2]),
        ("b", "ham", [9]),
        ("c", "ham", []),
    ]
    paths = {m: str(tmp_path / m) for m in ("x", "y", "z")}
    for m, target in paths.items():
        sinks.write_model_text(model.where(F.col("model_id") == m), target)
    assert rows(readers.ensemble_model_text(spark, paths)) == rows(model)
    (tmp_path / "tiny").write_text("(12,-1.5E-5)\n")
    assert rows(readers.model_text(spark, str(tmp_path / "tiny"))) == [("model", 12, -1.5e-5)]


def test_scores_hold_the_model_only(spark, instances, model):
    """The features of the instances pass by unsorted; a sort of them grows with the instances."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        scored = classify.apply_model(instances, model, "m0")
        assert "SortMergeJoin" not in plan(scored, "simple") and "ShuffledHashJoin" in plan(scored, "simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_features_are_counted_inside_their_row(spark):
    schema = "doc_id int, features array<int>"
    frame = spark.createDataFrame([(1, [5, 3, 5, None, 5]), (2, []), (3, None), (4, [None]), (1, [3])], schema)
    counted = classify.with_cells(frame, "doc_id")
    assert sorted(tuple(r) for r in counted.collect()) == [(1, [3], [1]), (1, [3, 5], [1, 3]), (2, [], []), (3, [], []), (4, [], [])]
    assert "Exchange" not in plan(counted, "simple")


def test_training_keeps_a_row_per_instance(spark):
    rows_in = [("a", 1, "spam", [1, 1, 2]), ("a", 1, "spam", [2]), ("a", 2, "ham", [])]
    frame = spark.createDataFrame(rows_in, "model_id string, doc_id int, label string, features array<int>")
    counted = training._counted(frame)
    assert counted.count() == 3 and "Exchange" not in plan(counted, "simple")
