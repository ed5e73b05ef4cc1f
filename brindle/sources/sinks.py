"""Sinks: overwriting pair output, the term-sorted index, stream output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from brindle.operators.index import bucket_of

#: Blocks of ids per file of a stored index.
FILE_BLOCKS = 1_024


def write_table(df: DataFrame, path: str, format: str = "parquet", **options: str) -> None:
    """Replace the folder at ``path``; ``format`` chooses a text form (csv, json, text) or a binary one."""
    df.write.mode("overwrite").format(format).options(**options).save(path)


def write_pairs_text(df: DataFrame, path: str, key: list[str], value: list[str]) -> None:
    """Write ``((k1, k2), (v1, v2))`` lines, replacing the folder."""

    def group(names: list[str]) -> Column:
        joined = F.concat_ws(", ", *[F.col(name).cast("string") for name in names])
        return joined if len(names) == 1 else F.concat(F.lit("("), joined, F.lit(")"))

    line = F.concat(F.lit("("), group(key), F.lit(", "), group(value), F.lit(")"))
    df.select(line.alias("value")).write.mode("overwrite").text(path)


def write_model_text(model: DataFrame, path: str) -> None:
    """Write one model as ``(feature,weight)`` lines."""
    model.select(F.format_string("(%s,%s)", F.col("feature").cast("string"), F.col("weight").cast("string"))).write.mode(
        "overwrite"
    ).text(path)


def write_pipe_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("sep", "|").option("quote", "").option("emptyValue", "").csv(path)


def write_index(index: DataFrame, path: str, buckets: int) -> None:
    """Write postings to a folder per bucket of terms, sorted by term and block inside each file.

    A lookup of a term (``index.lookup``) opens its bucket's folder only, and sorted files give narrow term ranges per
    row group.  The files of a bucket hold FILE_BLOCKS blocks of ids each, so the blocks of a very frequent term
    are written by many tasks.
    """
    number = F.lit(buckets)
    rows = index.withColumn("buckets", number).withColumn("bucket", bucket_of(F.col("term"), number))
    (
        rows.repartition(buckets, "bucket", F.expr(f"block div {FILE_BLOCKS}"))
        .sortWithinPartitions("bucket", "term", "block")
        .write.mode("overwrite")
        .partitionBy("buckets", "bucket")
        .parquet(path)
    )


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The stored index, with the number of buckets and each row's bucket."""
    return spark.read.parquet(path)


def write_in_ranges(df: DataFrame, path: str, column: str, files: int) -> None:
    """Write a table as ``files`` files at most, whose names are in the order of the column and whose rows are too."""
    df.repartitionByRange(files, column).sortWithinPartitions(column).write.parquet(path)


def write_batch(batch: DataFrame, path: str, batch_id: int) -> None:
    """Write one micro-batch to a folder of its own; the same batch again replaces it."""
    batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch_id}")


def stream_in_batches(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write every micro-batch of a stream once, under its number; ``batch`` is a column of what is read back.

    A batch that was written but not committed is repeated after a restart under the same number, so it replaces
    what it wrote before and nothing is there twice.
    """
    return (
        df.writeStream.outputMode("append")
        .foreachBatch(lambda batch, batch_id: write_batch(batch, path, batch_id))
        .option("checkpointLocation", checkpoint)
        .start()
    )


def run_to_end(query: StreamingQuery) -> None:
    """Wait until a query has taken all that is there, and stop it."""
    query.processAllAvailable()
    query.stop()


def stream_to_parquet(
    df: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None, available_now: bool = True
) -> StreamingQuery:
    """Append a stream to Parquet with exactly-once files; with ``available_now`` it ends with the present input."""
    writer = (
        df.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.start()
