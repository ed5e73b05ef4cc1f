"""Shared pieces of the operators: word splitting, stored intermediate tables."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.session import work_path

# White space and word classes as Java regular expressions.
SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_of(column: Column | str) -> Column:
    """The text, empty for null."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def words(text: Column, separator: str = SPACE) -> Column:
    """Words of a text that is not null, as an array."""
    return F.array_remove(F.split(text, separator), "")


def ascii_lower(text: Column) -> Column:
    """A-Z lowered and every other character kept (``lower`` alone would change accented capitals)."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def shingle_hashes(tokens: Column, width: int) -> Column:
    """64-bit hashes of all windows of ``width`` words, in order, repeated ones included.

    ``tokens`` should be a plain column: each window refers to it, and an expression would be evaluated each time.

    A shorter sequence that is not empty is one window; an empty one has none.
    """
    return F.when(
        F.size(tokens) >= width,
        F.transform(
            F.slice(tokens, F.lit(1), F.greatest(F.size(tokens) - (width - 1), F.lit(0))),
            lambda word, at: F.xxhash64(word, *[F.get(tokens, at + k) for k in range(1, width)]),
        ),
    ).otherwise(F.when(F.size(tokens) > 0, F.array(F.xxhash64(tokens))).otherwise(F.array().cast("array<bigint>")))


@contextmanager
def _files_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the jobs inside are removed when each job has ended."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the shared folder and read back, which cuts the lineage.

    Every executor can read the files, so losing one costs the running tasks only.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    with _files_freed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
