"""Sparse linear classifiers: apply, ensemble.

``instances``: (doc_id, label, features array<int>), repeats allowed.  ``model``: (model_id, feature,
weight).  A feature without a weight counts 0, and so does an instance without features.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The two classes and the names of the ensemble methods.
SPAM = "spam"
HAM = "ham"
METHODS = ("average", "vote")


def feature_counts(instances: DataFrame) -> DataFrame:
    """(doc_id, label, feature, n): occurrences of each feature; feature NULL where there is none."""
    rows = instances.select("doc_id", "label", F.explode_outer("features").alias("feature"))
    return rows.groupBy("doc_id", "label", "feature").agg(F.count("*").alias("n"))


def feature_counts(instances: DataFrame) -> DataFrame:
    """(doc_id, label, feature, n): occurrences of each feature; feature NULL where there is none."""
    rows = instances.select("doc_id", "label", F.explode_outer("features").alias("feature"))
    return rows.groupBy("doc_id", "label", "feature").agg(F.count("*").alias("n"))


def with_cells(instances: DataFrame, *columns: str) -> DataFrame:
    """The columns and two arrays: ``feature``, ascending and without null, and ``n``, the occurrences of each.

    An instance is counted inside its row, from its sorted features, so nothing is shuffled or grouped for it.
    """
    features = F.filter(F.coalesce("features", F.array().cast("array<int>")), lambda f: f.isNotNull())
    rows = instances.select(*columns, F.sort_array(features).alias("ordered"))
    first = F.transform("ordered", lambda f, at: F.when((at == 0) | (F.get("ordered", at - 1) != f), at))
    rows = rows.select(*columns, "ordered", F.filter(first, lambda at: at.isNotNull()).alias("first"))
    return rows.select(
        *columns,
        F.transform("first", lambda at: F.get("ordered", at)).alias("feature"),
        F.transform("first", lambda at, k: F.coalesce(F.get("first", k + 1), F.size("ordered")) - at).alias("n"),
    )


def predicted(score: Column) -> Column:
    return F.when(score > 0, SPAM).otherwise(HAM)


def _scores(instances: DataFrame, model: DataFrame, model_ids: list[str]) -> DataFrame:
    """(doc_id, label, s0, s1, ...): one score column per model, from one pass over the features.

    The model becomes one row per feature with a weight column per model.  Both sides are shuffled by feature,
    and a task holds its part of the model only: the instances' rows, one per distinct feature, pass by unsorted.
    """
    weights = [
        F.coalesce(F.sum(F.when(F.col("model_id") == m, F.col("weight"))), F.lit(0.0)).alias(f"w{i}")
        for i, m in enumerate(model_ids)
    ]
    wide = model.where(F.col("model_id").isin(model_ids)).groupBy("feature").agg(*weights)
    rows = with_cells(instances, "doc_id", "label").select("doc_id", "label", F.inline_outer(F.arrays_zip("feature", "n")))
    sums = [
        F.sum(F.coalesce(F.col(f"w{i}") * F.col("n"), F.lit(0.0))).alias(f"s{i}") for i in range(len(model_ids))
    ]
    return rows.join(wide.hint("shuffle_hash"), "feature", "left").groupBy("doc_id", "label").agg(*sums)


def apply_model(instances: DataFrame, model: DataFrame, model_id: str = "model") -> DataFrame:
    """(doc_id, label, score, predicted) by one model; a score of exactly 0 is ham."""
    scored = _scores(instances, model, [model_id])
    return scored.select("doc_id", "label", F.col("s0").alias("score"), predicted(F.col("s0")).alias("predicted"))


def apply_ensemble(instances: DataFrame, model: DataFrame, model_ids: list[str], method: str) -> DataFrame:
    """(doc_id, label, score, predicted) by several models.

    ``average``: the mean of their scores.  ``vote``: +1 for each score above 0 and -1 otherwise, summed.
    """
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}, not {method!r}")
    columns = [F.col(f"s{i}") for i in range(len(model_ids))]
    if method == "average":
        score = sum(columns[1:], columns[0]) / len(columns)
    else:
        votes = [F.when(c > 0, 1.0).otherwise(-1.0) for c in columns]
        score = sum(votes[1:], votes[0])
    scored = _scores(instances, model, model_ids).withColumn("score", score)
    return scored.select("doc_id", "label", "score", predicted(F.col("score")).alias("predicted"))
