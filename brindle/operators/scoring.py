"""Quality measures of scored instances (doc_id, label, score, predicted).

Scores are counted per distinct value first, so ties and very common scores cost one row.  Distinct
values are then cut into at most ``SCORE_BUCKETS`` ranges of about equal size.  Running sums are taken
inside a range, and the ranges are put together from one row each, so nothing sorts all scores in one
task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle.functions.numeric import RATE_BOUNDS, logit, rate_bucket, unlogit
from brindle.operators.classify import HAM, SPAM
from brindle.session import shared_dir

SCORE_BUCKETS = 256
SKETCH_PARTS = 64
SKETCH_ACCURACY = 1_000
#: Weight vectors that a task of the bootstrap sums up at once, and keeps before it passes them on.
VECTORS = 4_096

# Resamples of the bootstrap, the width of its interval in standard deviations.
RESAMPLES = 100
INTERVAL = 1.96

# Poisson(1) distribution function in steps of 2**-32, until it is 1 at that precision.
POISSON_STEPS = [
    int(2**32 * sum(math.exp(-1) / math.factorial(i) for i in range(k + 1))) for k in range(13)
]


def _class_counts(weight: Column | None = None) -> list[Column]:
    one = F.lit(1) if weight is None else weight
    count = lambda condition: F.sum(F.when(condition, one).otherwise(0))
    ham, spam = F.col("label") == HAM, F.col("label") != HAM
    return [
        count(ham).alias("hams"),
        count(spam).alias("spams"),
        count(ham & (F.col("predicted") != HAM)).alias("fp"),
        count(spam & (F.col("predicted") != SPAM)).alias("fn"),
    ]


def _score_counts(scores: DataFrame) -> DataFrame:
    """Class counts per distinct score, written once: the ranges and the sums both read them."""
    shared_dir(scores.sparkSession)
    return scores.groupBy("score").agg(*_class_counts()).checkpoint()


def _with_range(rows: DataFrame, counts: DataFrame, buckets: int) -> DataFrame:
    """Add ``bucket``, the score range: how many of the approximate quantiles lie below the score."""
    steps = [i / buckets for i in range(1, buckets)]
    # Quantiles of quantiles: the sketches of all partitions are merged in several tasks, not in one.
    # Any bounds give the same sums; good ones make the ranges even.
    parts = counts.groupBy(F.pmod(F.hash("score"), F.lit(SKETCH_PARTS)).alias("part")).agg(
        F.percentile_approx("score", steps, SKETCH_ACCURACY).alias("bounds")
    )
    bounds = (
        parts.select(F.explode("bounds").alias("bound"))
        .agg(F.percentile_approx("bound", steps, SKETCH_ACCURACY).alias("bounds"))
        .scalar()
    )
    below = F.filter("bounds", lambda b: b < F.col("score"))
    return rows.withColumn("bounds", bounds).withColumn("bucket", F.size(below)).drop("bounds")


SUMS = ("hams", "spams", "fp", "fn")


def _inversions(cells: DataFrame, by: list[str]) -> DataFrame:
    """(by..., hams, spams, fp, fn, inversions) from (by..., bucket, score, hams, spams, fp, fn).

    An inversion is a (spam, ham) pair with the spam scored below the ham; a tie counts one half.
    """
    inside = Window.partitionBy(*by, "bucket").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("spams").over(inside), F.lit(0))
    local = cells.withColumn("part", F.col("hams") * (below + 0.5 * F.col("spams")))
    ranges = local.groupBy(*by, "bucket").agg(*[F.sum(c).alias(c) for c in SUMS], F.sum("part").alias("part"))
    return _combined(ranges, by)


def _combined(ranges: DataFrame, by: list[str]) -> DataFrame:
    """``_inversions`` from one row per range, at most SCORE_BUCKETS of them for each key."""
    before = Window.partitionBy(*by).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("spams").over(before), F.lit(0)).cast("double")
    joined = ranges.withColumn("part", F.col("part") + F.col("hams") * offset)
    return joined.groupBy(*by).agg(*[F.sum(c).alias(c) for c in SUMS], F.sum("part").alias("inversions"))


def _area() -> Column:
    """Share of inverted pairs; none at all counts as half a pair."""
    pairs = F.col("hams").cast("double") * F.col("spams")
    return F.when(pairs > 0, F.greatest(F.col("inversions"), F.lit(0.5)) / pairs)


def _lam() -> Column:
    """Mean logit of the two misclassification rates; NULL if either is 0 or 1."""
    rate = lambda wrong, total: F.col(wrong) / F.nullif(F.col(total), F.lit(0))
    return (logit(rate("fn", "spams")) + logit(rate("fp", "hams"))) / 2


def roc_area(scores: DataFrame, buckets: int = SCORE_BUCKETS) -> DataFrame:
    """One row (hams, spams, inversions, roca_pct): 100 times the area above the ROC curve."""
    counts = _score_counts(scores)
    cells = _with_range(counts, counts, buckets)
    return _inversions(cells, []).select("hams", "spams", "inversions", (100 * _area()).alias("roca_pct"))


def confusion(scores: DataFrame) -> DataFrame:
    """One row (hams, spams, fp, fn): ham called spam is a false positive, spam called ham a false negative."""
    return scores.agg(*_class_counts())


def lam(scores: DataFrame) -> DataFrame:
    """One row (fp, fn, lam_pct): the mean logit of both error rates, as a percentage."""
    return confusion(scores).select("fp", "fn", (100 * unlogit(_lam())).alias("lam_pct"))


def rate_curve(scores: DataFrame, buckets: int = SCORE_BUCKETS) -> DataFrame:
    """(bucket, bound, fp_at_fn, fn_at_fp): the lowest rate of one error where the other falls in a bucket.

    Each distinct score is a cut: spam at or below it is missed, ham above it is rejected.  A count of
    0 is taken as one half.  Buckets without a cut have no row.
    """
    counts = _score_counts(scores)
    # Quantiles are approximate and two plans read the ranges; the checkpoint gives both the same ones.
    cells = _with_range(counts, counts, buckets).checkpoint()
    ranges = cells.groupBy("bucket").agg(F.sum("hams").alias("range_hams"), F.sum("spams").alias("range_spams"))
    ahead = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = ranges.select(
        "bucket",
        F.coalesce(F.sum("range_hams").over(ahead), F.lit(0)).alias("hams_before"),
        F.coalesce(F.sum("range_spams").over(ahead), F.lit(0)).alias("spams_before"),
        F.sum("range_hams").over(everything).alias("all_hams"),
        F.sum("range_spams").over(everything).alias("all_spams"),
    )
    inside = Window.partitionBy("bucket").orderBy("score").rowsBetween(Window.unboundedPreceding, 0)
    running = cells.select(
        "bucket", F.sum("hams").over(inside).alias("run_hams"), F.sum("spams").over(inside).alias("run_spams")
    )
    # At most SCORE_BUCKETS rows of offsets: safe to broadcast at any size of the scores.
    cuts = running.join(F.broadcast(offsets), "bucket")
    fp = F.col("all_hams") - F.col("hams_before") - F.col("run_hams")
    fn = F.col("spams_before") + F.col("run_spams")
    rate = lambda n, total: F.greatest(n.cast("double"), F.lit(0.5)) / F.nullif(F.col(total), F.lit(0))
    points = cuts.select(rate(fp, "all_hams").alias("fp_rate"), rate(fn, "all_spams").alias("fn_rate"))
    nothing = F.lit(None).cast("double")
    sides = F.array(
        F.struct(rate_bucket("fn_rate").alias("bucket"), F.col("fp_rate").alias("a"), nothing.alias("b")),
        F.struct(rate_bucket("fp_rate").alias("bucket"), nothing.alias("a"), F.col("fn_rate").alias("b")),
    )
    bounds = F.array(*[F.lit(b) for b in RATE_BOUNDS])
    return (
        points.select(F.inline(sides).alias("bucket", "a", "b"))
        .groupBy("bucket")
        .agg(F.min("a").alias("fp_at_fn"), F.min("b").alias("fn_at_fp"))
        .select("bucket", F.get(bounds, F.col("bucket")).alias("bound"), "fp_at_fn", "fn_at_fp")
    )


def draws(doc_id: str, resamples: int, seed: int) -> Column:
    """A number below 2**32 for each resample that depends on id, resample and seed alone."""

    def draw(replicate: Column) -> Column:
        text = F.concat_ws(":", F.lit(str(seed)), replicate.cast("string"), F.col(doc_id).cast("string"))
        return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")

    return F.transform(F.sequence(F.lit(0), F.lit(resamples - 1)), draw)


def poisson_weights(drawn: np.ndarray) -> np.ndarray:
    """Poisson(1) weights of numbers that are even below 2**32."""
    return np.searchsorted(POISSON_STEPS, drawn, side="right")


def _summed(keys: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of keys in order, and the sums of their vectors."""
    order = np.lexsort(keys.T[::-1])
    keys, vectors = keys[order], vectors[order]
    starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
    return keys[starts], np.add.reduceat(vectors, starts)


def _weighted_cells(drawn: DataFrame, resamples: int) -> DataFrame:
    """(bucket, score, spam, weights, wrong): the vectors of a class and score, summed up in each task.

    From (bucket, score, spam, wrong, draws); ``wrong`` of an instance is whether it is misclassified.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, vectors = np.zeros((0, 3)), np.zeros((0, 2 * resamples), dtype=np.int64)

        def batch_of() -> pa.RecordBatch:
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(v.ravel()), resamples).cast(pa.list_(pa.int64())) for v in np.split(vectors, 2, axis=1)]
            names = ["bucket", "score", "spam", "weights", "wrong"]
            return pa.RecordBatch.from_arrays([pa.array(keys[:, 0].astype(np.int32)), pa.array(keys[:, 1]), pa.array(keys[:, 2] > 0), *lists], names=names)

        for batch in batches:
            for at in range(0, batch.num_rows, VECTORS):
                own = batch[at : at + VECTORS]
                weights = poisson_weights(own.column("draws").flatten().to_numpy().reshape(-1, resamples))
                named = np.stack([own.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("bucket", "score", "spam")], axis=1)
                wrong = weights * own.column("wrong").to_numpy(zero_copy_only=False)[:, None]
                keys, vectors = _summed(np.concatenate([keys, named]), np.concatenate([vectors, np.hstack([weights, wrong])]))
                if len(keys) > VECTORS:
                    yield batch_of()
                    keys, vectors = keys[:0], vectors[:0]
        if len(keys):
            yield batch_of()

    return drawn.mapInArrow(run, "bucket int, score double, spam boolean, weights array<bigint>, wrong array<bigint>")


def _weighted_ranges(cells: DataFrame, resamples: int) -> DataFrame:
    """(replicate, bucket, hams, spams, fp, fn, part) as ``_combined`` takes it, a range at a time."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        named = np.stack([table.column(c).to_numpy().astype(float) for c in ("score", "spam")], axis=1)
        vectors = [table.column(c).combine_chunks().flatten().to_numpy().reshape(-1, resamples) for c in ("weights", "wrong")]
        keys, sums = _summed(named, np.hstack(vectors))
        weights, wrong = np.split(sums, 2, axis=1)
        spam = keys[:, 1:] > 0
        spams, hams = weights * spam, weights * ~spam
        # Spams of a score stand behind its hams: those below a ham are all before it, and half of those at its score.
        scores, at = np.unique(keys[:, 0], return_inverse=True)
        by_score = np.zeros((len(scores), resamples), dtype=np.int64)
        np.add.at(by_score, at, spams)
        below = np.cumsum(by_score, axis=0) - 0.5 * by_score
        part = (hams * below[at]).sum(axis=0)
        found = [hams.sum(axis=0), spams.sum(axis=0), (wrong * ~spam).sum(axis=0), (wrong * spam).sum(axis=0), part]
        bucket = pa.array([table.column("bucket")[0].as_py()] * resamples, pa.int32())
        return pa.Table.from_arrays([pa.array(np.arange(resamples, dtype=np.int32)), bucket, *map(pa.array, found)], names=["replicate", "bucket", *SUMS, "part"])

    return cells.groupBy("bucket").applyInArrow(
        run, "replicate int, bucket int, hams bigint, spams bigint, fp bigint, fn bigint, part double"
    )


def bootstrap(scores: DataFrame, resamples: int = RESAMPLES, seed: int = 1, buckets: int = SCORE_BUCKETS) -> DataFrame:
    """One row: the ROC measure and lam, each with an interval of +-1.96 deviations on the logit scale.

    A resample gives every instance a Poisson(1) weight, the usual stand-in for drawing n of n with
    replacement when rows are spread over many tasks.  An instance keeps one row with a vector of weights;
    tasks sum the vectors per class and score before the shuffle, and a range of scores is one group behind it.
    A resample without a finite logit is left out of the deviation.
    """
    shared_dir(scores.sparkSession)
    scores = scores.select("doc_id", "label", "score", "predicted").checkpoint()
    counts = _score_counts(scores)
    spam = F.col("label") != HAM
    wrong = F.when(spam, F.col("predicted") != SPAM).otherwise(F.col("predicted") != HAM)
    drawn = _with_range(scores, counts, buckets).select(
        "bucket", "score", spam.alias("spam"), wrong.alias("wrong"), draws("doc_id", resamples, seed).alias("draws")
    )
    ranges = _weighted_ranges(_weighted_cells(drawn, resamples), resamples)
    spread = (
        _combined(ranges, ["replicate"])
        .select(logit(_area()).alias("x"), _lam().alias("lam"))
        .agg(F.stddev_samp("x").alias("sd_x"), F.stddev_samp("lam").alias("sd_lam"))
    )
    point = _inversions(_with_range(counts, counts, buckets), []).select(
        logit(_area()).alias("x"), _lam().alias("lam")
    )
    both = point.select("x", "lam", spread.select(F.struct("sd_x", "sd_lam").alias("sd")).scalar().alias("sd"))
    interval = []
    for name, value, sd in (("roca", F.col("x"), F.col("sd.sd_x")), ("lam", F.col("lam"), F.col("sd.sd_lam"))):
        interval += [
            (100 * unlogit(value)).alias(f"{name}_pct"),
            (100 * unlogit(value - INTERVAL * sd)).alias(f"{name}_low"),
            (100 * unlogit(value + INTERVAL * sd)).alias(f"{name}_high"),
        ]
    return both.select(*interval)
