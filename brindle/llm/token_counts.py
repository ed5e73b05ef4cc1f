"""Token counts as delta-maintained rollups.

A batch is a table of signed changes: an insert adds a document's count, a delete takes it away, a revision adds
the difference.  ``commit`` adds a batch up by source, language and tokenizer version and writes these few rows
under the batch's id; ``totals`` adds the committed batches up, so no total is ever rewritten.  Committing an
id again changes nothing, whatever became of the first try: a batch counts when its folder has the
completion mark that Spark writes last, and an unfinished folder is replaced.

Defined results: null and empty texts count no tokens but one document.  Null source or language is a group
of its own.  Rows with equal ids are counted each; a null id is a change like any other, and equal ids or two null ids
within one side of ``changes`` pair with each other by their counts' order.  Empty batches commit no rows.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from brindle.llm._common import SPACE, text_of, words

KEYS = ("source", "lang", "version")
MEASURES = ("n_docs", "n_tokens")
SCHEMA = "source string, lang string, version string, n_docs bigint, n_tokens bigint"


def word_counts(documents: DataFrame, version: str = "words-1", separator: str = SPACE) -> DataFrame:
    """(doc_id, source, lang, version, n_tokens) by a pattern of what separates words, white space at first."""
    counts = F.size(words(text_of("text"), separator)).cast("long")
    return documents.select("doc_id", "source", "lang", F.lit(version).alias("version"), counts.alias("n_tokens"))


def tiktoken_counts(documents: DataFrame, ranks: dict[bytes, int], pattern: str, version: str) -> DataFrame:
    """(doc_id, source, lang, version, n_tokens) by a byte-level BPE given as ranks."""
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        encoding = tiktoken.Encoding(version, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        for batch in batches:
            counts = [len(encoding.encode_ordinary(t)) if t else 0 for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", "source", "lang")]
                + [pa.array([version] * len(counts), pa.string()), pa.array(counts, pa.int64())],
                names=["doc_id", "source", "lang", "version", "n_tokens"],
            )

    rows = documents.select("doc_id", "source", "lang", "text")
    return rows.mapInArrow(run, f"doc_id {kind}, source string, lang string, version string, n_tokens bigint")


def changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Signed changes that lead from one state (doc_id, source, lang, version, n_tokens) to another.

    Rows of both sides that agree in id and version are one revision; what only one side has is a delete or
    an insert.  A revision that moves a document between groups is a delete in one and an insert in the other.
    """
    identity = ["doc_id", "version"]

    def numbered(rows: DataFrame, sign: int) -> DataFrame:
        order = F.row_number().over(W.partitionBy(*identity).orderBy("source", "lang", "n_tokens"))
        return rows.withColumn("copy", order).withColumn("sign", F.lit(sign))

    both = numbered(before, -1).unionByName(numbered(after, 1))
    return both.groupBy(*identity, "copy", "source", "lang").agg(
        F.sum("sign").cast("long").alias("n_docs"), F.sum(F.col("sign") * F.col("n_tokens")).alias("n_tokens")
    ).where("n_docs <> 0 or n_tokens <> 0").select(*identity, "source", "lang", "n_docs", "n_tokens")


def inserts(state: DataFrame) -> DataFrame:
    return state.withColumn("n_docs", F.lit(1).cast("long"))


def deletes(state: DataFrame) -> DataFrame:
    return state.withColumn("n_docs", F.lit(-1).cast("long")).withColumn("n_tokens", -F.col("n_tokens"))


def _finished(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def commit(batch: DataFrame, ledger: str, batch_id: str) -> bool:
    """Add a batch of changes to the ledger; False if the id was committed before."""
    spark, path = batch.sparkSession, f"{ledger}/batch_id={batch_id}"
    if _finished(spark, path):
        return False
    sums = batch.groupBy(*KEYS).agg(*[F.sum(m).cast("long").alias(m) for m in MEASURES])
    sums.write.mode("overwrite").parquet(path)
    return True


def totals(spark: SparkSession, ledger: str, batch_ids: list[str]) -> DataFrame:
    """Totals over the committed ones of the batches; groups that came down to nothing are left out."""
    paths = [path for path in (f"{ledger}/batch_id={b}" for b in batch_ids) if _finished(spark, path)]
    rows = spark.read.schema(SCHEMA).parquet(*paths) if paths else spark.createDataFrame([], SCHEMA)
    sums = rows.groupBy(*KEYS).agg(*[F.sum(m).alias(m) for m in MEASURES])
    return sums.where("n_docs <> 0 or n_tokens <> 0")


def repeated(documents: DataFrame, state: DataFrame) -> DataFrame:
    """Rows of the state whose document has an equal text under a smaller id; ids are unique and not null."""
    keys = documents.select("doc_id", F.xxhash64("text").alias("a"), F.xxhash64(F.lit(1), F.col("text")).alias("b"))
    firsts = keys.groupBy("a", "b").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    copies = keys.join(firsts, ["a", "b"]).where("doc_id <> first").select("doc_id")
    return state.join(copies, "doc_id", "left_semi")
