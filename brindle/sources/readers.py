"""Readers for the input shapes of the jobs; each returns a DataFrame and reads nothing eagerly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.functions.text import split_fields, split_lines
from brindle.sources.named_files import NamedFiles
from brindle.sources.schemas import TABLES

# Field positions in a trip record (taxi type first; drop-off point by layout).
GREEN_POINT = (8, 9)
OTHER_POINT = (10, 11)


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Plain text as (line)."""
    return spark.read.text(path).withColumnRenamed("value", "line")


def document_lines(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Lines of a document table as (doc_id, line_no, line); line numbers start at 0."""
    return documents.select(
        F.col(doc_id).alias("doc_id"), F.posexplode(split_lines(text)).alias("line_no", "line")
    )


def parquet_table(spark: SparkSession, folder: str, name: str, suffix: str = ".parquet") -> DataFrame:
    """One Parquet file or directory per table."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}{suffix}")


def pipe_table(
    spark: SparkSession, path: str, name: str, schema: str | None = None, trailing: bool = False
) -> DataFrame:
    """A '|'-delimited table with its declared schema (or another one given as DDL).

    ``trailing`` says that lines end in a delimiter, which makes one field more than the schema has.  Fields are
    trimmed.  A line with another number of fields, or a field that does not fit its declared type, fails the job.
    """
    schema = schema or TABLES[name]
    rows = spark.read.csv(
        path,
        sep="|",
        schema=f"{schema}, _trailing string" if trailing else schema,
        mode="FAILFAST",
        ignoreLeadingWhiteSpace=True,
        ignoreTrailingWhiteSpace=True,
        quote="",
    )
    return rows.drop("_trailing")


def adjacency_lists(spark: SparkSession, path: str) -> DataFrame:
    """Adjacency text ``id n1 n2 ...`` as (id, neighbours); a lone id has an empty list."""
    return adjacency_from_lines(text_lines(spark, path))


def adjacency_from_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    fields = lines.where(F.trim(line) != "").select(split_fields(line).cast("array<bigint>").alias("fields"))
    return fields.select(
        F.col("fields")[0].alias("id"),
        F.slice("fields", F.lit(2), F.size("fields")).alias("neighbours"),
    )


def labelled_instances(spark: SparkSession, path: str) -> DataFrame:
    """Instance text ``docid label f1 f2 ...`` as (doc_id, label, features)."""
    return instances_from_lines(text_lines(spark, path))


def instances_from_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    fields = lines.where(F.trim(line) != "").select(split_fields(line).alias("fields"))
    return fields.select(
        F.col("fields")[0].alias("doc_id"),
        F.col("fields")[1].alias("label"),
        F.slice("fields", F.lit(3), F.size("fields")).cast("array<int>").alias("features"),
    )


def model_text(spark: SparkSession, path: str, model_id: str = "model") -> DataFrame:
    """Model text, one ``(feature,weight)`` per line, as (model_id, feature, weight)."""
    line = F.trim(F.col("line"))
    return (
        text_lines(spark, path)
        .where(line != "")
        .select(
            F.lit(model_id).alias("model_id"),
            F.regexp_extract(line, r"^\(([^,]+),([^)]+)\)$", 1).cast("int").alias("feature"),
            F.regexp_extract(line, r"^\(([^,]+),([^)]+)\)$", 2).cast("double").alias("weight"),
        )
    )


def ensemble_model_text(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Several model texts, keyed by model id, as one model table."""
    parts = [model_text(spark, path, model_id) for model_id, path in paths.items()]
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    return table


def trip_point(fields: str | Column) -> tuple[Column, Column]:
    """Drop-off point of a split trip record; which fields hold it depends on the taxi type."""
    fields = F.col(fields) if isinstance(fields, str) else fields
    green = F.contains(F.lower(fields[0]), F.lit("green"))
    x, y = (
        F.when(green, fields[a]).otherwise(fields[b]).cast("double") for a, b in zip(GREEN_POINT, OTHER_POINT)
    )
    return x, y


def decode_trips(lines: DataFrame, line: str = "line", time_field: int | None = None) -> DataFrame:
    """Trip records as (kind, x, y) and, if ``time_field`` names its position, the event time ``ts``.

    Works on a table and on a stream.  A point that is not a number fails the job.
    """
    fields = lines.select(F.split(line, ",").alias("fields"))
    x, y = trip_point("fields")
    columns = [F.col("fields")[0].alias("kind"), x.alias("x"), y.alias("y")]
    if time_field is not None:
        columns.append(F.col("fields")[time_field].cast("timestamp").alias("ts"))
    return fields.select(*columns)


def ordered_file_stream(
    spark: SparkSession, folder: str, schema: str, files_per_batch: int = 1, format: str = "parquet"
) -> DataFrame:
    """A stream over the ``part-*`` files of a folder, oldest first, a few files per micro-batch."""
    return (
        spark.readStream.schema(schema)
        .format(format)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("latestFirst", "false")
        .option("pathGlobFilter", "part-*")
        .option("recursiveFileLookup", "true")
        .load(folder)
    )


def named_file_stream(
    spark: SparkSession, folder: str, schema: str, checkpoint: str, files_per_batch: int = 1, format: str = "parquet"
) -> DataFrame:
    """A stream over the ``part-*`` files of a folder in the order of their names, a few files per micro-batch.

    ``checkpoint`` is the checkpoint folder of the query that will read it; ``format`` is parquet or text.
    """
    spark.dataSource.register(NamedFiles)
    return (
        spark.readStream.schema(schema)
        .format(NamedFiles.name())
        .option("fileFormat", format)
        .option("filesPerBatch", files_per_batch)
        .option("checkpoint", checkpoint)
        .load(folder)
    )
