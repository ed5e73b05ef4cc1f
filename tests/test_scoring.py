"""Quality measures against direct computations over all instances."""

import hashlib
import math
import random
import statistics

import numpy as np
import pytest
from conftest import plan

from brindle.functions.numeric import RATE_BOUNDS, fixed_point, logit, rate_bucket, unlogit
from brindle.operators import scoring

SCORES = "doc_id string, label string, score double, predicted string"


def tied_scores(n=300, seed=1):
    """A third of the instances shares one score; others repeat too."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        label = rng.choice(["spam", "ham", "ham"])
        score = 0.0 if i % 3 == 0 else round(rng.gauss(0.4 if label == "spam" else -0.4, 1), 1)
        out.append((str(i), label, score, "spam" if score > 0 else "ham"))
    return out


def frame(spark, data):
    return spark.createDataFrame(data, SCORES).repartition(3)


def area(weighted):
    hams = sum(w for _, label, _, w in weighted if label == "ham")
    spams = sum(w for _, label, _, w in weighted if label == "spam")
    inversions = sum(
        wh * ws * (1 if s < h else 0.5 if s == h else 0)
        for _, a, h, wh in weighted
        if a == "ham"
        for _, b, s, ws in weighted
        if b == "spam"
    )
    return hams, spams, inversions, max(inversions, 0.5) / (hams * spams)


@pytest.mark.parametrize("buckets", [scoring.SCORE_BUCKETS, 4, 2])
def test_roc_area(spark, buckets):
    data = tied_scores()
    got = scoring.roc_area(frame(spark, data), buckets).first()
    hams, spams, inversions, share = area([(d, label, s, 1) for d, label, s, _ in data])
    assert (got.hams, got.spams, got.inversions) == (hams, spams, inversions)
    assert math.isclose(got.roca_pct, 100 * share)


def test_perfect_ranking_counts_half_a_pair(spark):
    data = [("a", "ham", -1.0, "ham"), ("b", "ham", -0.5, "ham"), ("c", "spam", 2.0, "spam")]
    assert scoring.roc_area(frame(spark, data)).first().roca_pct == 100 * 0.5 / 2


def test_one_class_only_has_no_area(spark):
    got = scoring.roc_area(frame(spark, [("a", "ham", 1.0, "spam")])).first()
    assert got.roca_pct is None
    assert scoring.lam(frame(spark, [("a", "ham", 1.0, "spam")])).first().lam_pct is None


def test_confusion_and_lam(spark):
    data = tied_scores()
    fp = sum(label == "ham" and p == "spam" for _, label, _, p in data)
    fn = sum(label == "spam" and p == "ham" for _, label, _, p in data)
    hams = sum(label == "ham" for _, label, _, _ in data)
    assert tuple(scoring.confusion(frame(spark, data)).first()) == (hams, len(data) - hams, fp, fn)
    lg = lambda x: math.log(x / (1 - x))
    mean = (lg(fn / (len(data) - hams)) + lg(fp / hams)) / 2
    assert math.isclose(scoring.lam(frame(spark, data)).first().lam_pct, 100 / (1 + math.exp(-mean)))


@pytest.mark.parametrize("buckets", [scoring.SCORE_BUCKETS, 3])
def test_rate_curve(spark, buckets):
    data = tied_scores()
    hams = sum(label == "ham" for _, label, _, _ in data)
    spams = len(data) - hams
    quant = lambda x: next((i for i, b in enumerate(RATE_BOUNDS) if x <= b), 12)
    at_fn, at_fp = {}, {}
    for cut in {s for _, _, s, _ in data}:
        fp = max(sum(label == "ham" and s > cut for _, label, s, _ in data), 0.5) / hams
        fn = max(sum(label == "spam" and s <= cut for _, label, s, _ in data), 0.5) / spams
        at_fn[quant(fn)] = min(at_fn.get(quant(fn), 9), fp)
        at_fp[quant(fp)] = min(at_fp.get(quant(fp), 9), fn)
    got = {r.bucket: (r.bound, r.fp_at_fn, r.fn_at_fp) for r in scoring.rate_curve(frame(spark, data), buckets).collect()}
    assert got == {b: (RATE_BOUNDS[b], at_fn.get(b), at_fp.get(b)) for b in at_fn.keys() | at_fp.keys()}


def test_bootstrap(spark):
    data = tied_scores(90)
    seed, resamples = 3, 20
    lg = lambda x: math.log(x / (1 - x)) if 0 < x < 1 else None
    xs, lams = [], []
    for k in range(resamples):
        drawn = []
        for d, label, s, p in data:
            draw = int(hashlib.md5(f"{seed}:{k}:{d}".encode()).hexdigest()[:8], 16)
            drawn.append((d, label, s, sum(draw >= step for step in scoring.POISSON_STEPS), p))
        hams, spams, _, share = area([r[:4] for r in drawn])
        fp = sum(w for _, label, _, w, p in drawn if label == "ham" and p == "spam")
        fn = sum(w for _, label, _, w, p in drawn if label == "spam" and p == "ham")
        xs.append(lg(share))
        lams.append((lg(fn / spams) + lg(fp / hams)) / 2)
    got = scoring.bootstrap(frame(spark, data), resamples, seed).first()
    _, _, _, share = area([(d, label, s, 1) for d, label, s, _ in data])
    un = lambda x: 100 / (1 + math.exp(-x))
    sd = statistics.stdev(xs)
    expected = (un(lg(share)), un(lg(share) - 1.96 * sd), un(lg(share) + 1.96 * sd))
    assert all(math.isclose(a, b) for a, b in zip((got.roca_pct, got.roca_low, got.roca_high), expected))
    width = 1.96 * statistics.stdev(lams)
    center = lg(got.lam_pct / 100)
    assert math.isclose(got.lam_low, un(center - width)) and math.isclose(got.lam_high, un(center + width))


def test_poisson_weights_have_mean_and_variance_one(spark):
    drawn = spark.range(2_000).select(scoring.draws("id", 10, 1).alias("d")).toPandas()["d"]
    weights = scoring.poisson_weights(np.concatenate(drawn.to_list()))
    assert abs(weights.mean() - 1) < 0.03 and abs((weights**2).mean() - 2) < 0.1
    assert scoring.poisson_weights(np.array([0, scoring.POISSON_STEPS[0], scoring.POISSON_STEPS[1] - 1])).tolist() == [0, 1, 1]


def test_bootstrap_in_many_vectors(spark, monkeypatch):
    """The same result when sums leave the tasks early and ranges are few or many; no row is copied per resample."""
    data = frame(spark, tied_scores(300))
    expected = scoring.bootstrap(data, 10, 4).first()
    monkeypatch.setattr(scoring, "VECTORS", 7)
    for buckets in (2, 5, 50):
        assert all(math.isclose(a, b, rel_tol=1e-9) for a, b in zip(scoring.bootstrap(data, 10, 4, buckets).first(), expected))
    assert "explode(sequence" not in plan(scoring.bootstrap(data, 10, 4), "simple")


def test_numeric_functions(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 0.0001, 0.00011, 0.3, 0.5, 0.51, 1.0, 7.0)], "x double")
    assert [r[0] for r in df.select(rate_bucket("x")).collect()] == [0, 0, 1, 11, 11, 12, 12, 12]
    assert [r[0] is None for r in df.select(logit("x")).collect()] == [True, False, False, False, False, False, True, True]
    assert math.isclose(df.select(unlogit(logit("x"))).collect()[3][0], 0.3)
    assert df.select(fixed_point("x")).first()[0] == "0.00000"
