"""Training of sparse logistic models without a bias term.

The update is the same everywhere: an instance is scored with the weights so far, and every occurrence of
each of its features then adds (y - p) * delta.

``train_minibatch`` is the learner for tables of any size: one pass in ``BATCHES`` parts.  An instance's part
follows from a seeded hash of its id, so another seed is another random order.  All instances of a part are
scored with the weights of the parts before it.  Several models, keyed by ``model_id``, train in one job.

``train_batch`` takes full-batch steps; it has no order at all.

``train_mixed`` goes instance by instance at any size: the instances of a model are dealt to a fixed number of shards,
every shard is trained strictly in sequence from zero weights, and the weights are averaged by the shards' sizes
(parameter mixing).  With one shard it is the sequential pass.

``train_sgd`` is the strictly sequential pass, instance by instance, for labelled sets that are bounded by
``max_rows`` per model.  A larger set fails; it is not trained in another way.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import groupby

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.functions.numeric import sigmoid
from brindle.operators.classify import SPAM, with_cells
from brindle.session import shared_dir, written

# The learning rate.
DELTA = 0.002

#: Parts of one pass, at every size.
BATCHES = 8
#: Shards of the mixed pass, at every size.
SHARDS = 256
#: Labelled rows per model that the sequential learner accepts.
MAX_ROWS = 500_000


def random_position(key: str, seed: int) -> Column:
    """A reproducible random number below 2 ** 32 for each key, null for a null key."""
    text = F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def in_random_order(rows: DataFrame, key: str, seed: int) -> DataFrame:
    """The rows in a random order that only depends on key and seed; ``position`` is the sort key, ties go by key."""
    return rows.withColumn("position", random_position(key, seed)).orderBy("position", key)


def _counted(instances: DataFrame, *more: Column) -> DataFrame:
    """(model_id, doc_id, target, ..., feature, n): a row per instance, with its features and how often each occurs."""
    rows = instances.select("model_id", "doc_id", (F.col("label") == SPAM).cast("double").alias("target"), *more, "features")
    return with_cells(rows, *rows.columns[:-1])


def _steps(rows: DataFrame, weights: DataFrame | None, delta: float) -> DataFrame:
    """(model_id, feature, weight): what the instances of ``rows`` add to the weights.

    Scores come back to instances, not to their features, and both joins hold the smaller side only, unsorted.
    """
    cells = F.inline(F.arrays_zip("feature", "n"))
    if weights is None:
        scored, score = rows, F.lit(0.0)
    else:
        scores = (
            rows.select("model_id", "doc_id", cells)
            .join(weights.hint("shuffle_hash"), ["model_id", "feature"], "left")
            .groupBy("model_id", "doc_id")
            .agg(F.sum(F.coalesce("weight", F.lit(0.0)) * F.col("n")).alias("score"))
        )
        scored, score = rows.join(scores.hint("shuffle_hash"), ["model_id", "doc_id"]), F.col("score")
    errors = scored.select("model_id", (F.col("target") - sigmoid(score)).alias("error"), cells)
    return errors.groupBy("model_id", "feature").agg(F.sum(F.col("error") * F.col("n") * delta).alias("weight"))


def _trained(parts: Iterable[DataFrame], delta: float) -> DataFrame:
    """Weights after one step per part.  They are checkpointed in between, so each plan holds one step."""
    weights = None
    for rows in parts:
        if weights is None:
            weights = _steps(rows, None, delta)
            continue
        weights = weights.checkpoint()
        both = weights.unionByName(_steps(rows, weights, delta))
        weights = both.groupBy("model_id", "feature").agg(F.sum("weight").alias("weight"))
    return weights


def train_minibatch(instances: DataFrame, seed: int = 0, batches: int = BATCHES, delta: float = DELTA) -> DataFrame:
    """(model_id, feature, weight) from (model_id, doc_id, label, features), trained in one pass of ``batches`` parts.

    A model has a weight for every feature of its instances.  Instances with a null id are of part 0.
    """
    shared_dir(instances.sparkSession)
    part = F.coalesce(F.pmod(random_position("doc_id", seed), F.lit(batches)), F.lit(0)).cast("int").alias("part")
    rows = written(_counted(instances, part), "counted", "part")
    return _trained((rows.where(F.col("part") == number) for number in range(batches)), delta)


def train_batch(instances: DataFrame, epochs: int = 1, delta: float = DELTA, model_id: str = "model") -> DataFrame:
    """(model_id, feature, weight) after full-batch steps from zero weights over (doc_id, label, features)."""
    shared_dir(instances.sparkSession)
    rows = written(_counted(instances.withColumn("model_id", F.lit(model_id))), "counted")
    return _trained((rows for _ in range(epochs)), delta)


def _pass_over(rows: Iterable[tuple[int, Iterable[int]]], delta: float, max_rows: int) -> dict[int, float]:
    """One sequential pass over (target, features)."""
    weights: dict[int, float] = defaultdict(float)
    for number, (target, features) in enumerate(rows):
        if number >= max_rows:
            raise ValueError(f"a model has more than {max_rows} labelled rows")
        score = sum(weights.get(f, 0.0) for f in features)
        # exp(-score) overflows below about -709, where the probability is 0 in double precision.
        probability = 1.0 / (1.0 + math.exp(-score)) if score > -700 else 0.0
        change = (target - probability) * delta
        for f in features:
            weights[f] += change
    return weights


def _trainer(delta: float, max_rows: float):
    """Train each (model, shard) of a partition sorted by them, batch by batch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows():
            for batch in batches:
                yield from zip(zip(batch["model_id"], batch["shard"]), batch["target"], batch["features"])

        for (model_id, shard), group in groupby(rows(), key=lambda r: r[0]):
            weights = _pass_over(((r[1], r[2]) for r in group), delta, max_rows)
            yield pd.DataFrame(
                {
                    "model_id": model_id,
                    "shard": pd.Series([shard] * len(weights), dtype="int32"),
                    "feature": pd.Series(list(weights.keys()), dtype="int32"),
                    "weight": pd.Series(list(weights.values()), dtype="float64"),
                }
            )

    return run


def train_mixed(instances: DataFrame, shards: int = SHARDS, seed: int = 0, delta: float = DELTA) -> DataFrame:
    """(model_id, feature, weight) from (model_id, doc_id, label, features) by averaging shards trained in sequence.

    Shard and order follow from a seeded hash of the id; equal ids stand in the order of their label.  A task holds
    the weights of one shard's features and reads its instances as they come.  A feature that a shard has not seen
    has weight 0 there; shards weigh as many instances as they have.  A model without any feature has no rows.
    """
    position = F.coalesce(random_position("doc_id", seed), F.lit(0))
    rows = instances.select(
        "model_id",
        F.pmod(position, F.lit(shards)).cast("int").alias("shard"),
        (F.col("label") == SPAM).cast("int").alias("target"),
        F.filter(F.coalesce("features", F.array().cast("array<int>")), lambda f: f.isNotNull()).alias("features"),
        position.alias("position"),
        "doc_id",
    )
    # A row per model and shard, read twice.
    sizes = written(rows.groupBy("model_id", "shard").agg(F.count("*").alias("n")), "shard-sizes")
    totals = sizes.groupBy("model_id").agg(F.sum("n").alias("total"))
    ordered = rows.repartition("model_id", "shard").sortWithinPartitions("model_id", "shard", "position", "doc_id", "target")
    trained = ordered.select("model_id", "shard", "target", "features").mapInPandas(
        _trainer(delta, math.inf), "model_id string, shard int, feature int, weight double"
    )
    parts = trained.join(sizes, ["model_id", "shard"])
    summed = parts.groupBy("model_id", "feature").agg(F.sum(F.col("weight") * F.col("n")).alias("sum"))
    return summed.join(totals, "model_id").select("model_id", "feature", (F.col("sum") / F.col("total")).alias("weight"))


def train_sgd(
    instances: DataFrame,
    order_by: str = "doc_id",
    shuffle_seed: int | None = None,
    max_rows: int = MAX_ROWS,
    delta: float = DELTA,
) -> DataFrame:
    """(model_id, feature, weight) from (model_id, doc_id, label, features), instance by instance.

    Instances are taken in the order of ``order_by``, or in a reproducible random order if ``shuffle_seed`` is given.
    A model with more than ``max_rows`` labelled rows fails the job.
    """
    order = F.col(order_by) if shuffle_seed is None else random_position(order_by, shuffle_seed)
    target = (F.col("label") == SPAM).cast("int").alias("target")
    rows = instances.select("model_id", target, "features", order.alias("position"), F.col(order_by).alias("tie"))
    return (
        rows.repartition("model_id")
        .sortWithinPartitions("model_id", "position", "tie")
        .select("model_id", F.lit(0).alias("shard"), "target", "features")
        .mapInPandas(_trainer(delta, max_rows), "model_id string, shard int, feature int, weight double")
        .drop("shard")
    )
