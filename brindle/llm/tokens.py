"""Token ids as Parquet files that can be read selectively.

Documents are range-partitioned by id before they are encoded, so only their text is shuffled.  Each task sorts
its range and writes rows (doc_id, part, n_tokens, ids): ids as a list column, dictionary encoded while a row
group's distinct ids fit the dictionary page, delta-packed beyond (Parquet's version 2 writer), in row groups of ROW_GROUP
bytes with page indexes.  Readers that ask for some ids or only for lengths skip the other pages and columns.

The encoder cuts a text at single blanks between other characters, which the tokenizer's own splitting never
crosses, and asks the tokenizer once per distinct chunk that a worker meets; the ids are gathered by numpy.

Defined results: null and empty texts have the end id only.  Null ids come first, equal ids are ordered by
text.  An empty table gives empty files.  Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

END_ID = 2
ROW_GROUP = 16 << 20
PAGE_ROWS = 2_000
#: Bytes of chunks and ids that a worker remembers, the longest chunk it remembers, characters that are encoded at once.
REMEMBERED = 64_000_000
LONGEST = 64
AT_ONCE = 500_000
#: A blank between two other characters, which the tokenizer's own splitting never crosses, and white space beside which there is none.
CUT = re.compile(r"(?<=\S) (?=\S)")
UNEVEN = re.compile(r"\s | \s|^ | $")
#: A chunk of a blank and what is no white space; such chunks may stand behind each other.
PLAIN = re.compile(r" \S+")


class ChunkEncoder:
    """Ids of texts through a tokenizer that is asked once per chunk."""

    def __init__(self, tokenizer_json: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        # The library finds added tokens' strings before it splits; a text with one is not cut either.
        added = [re.escape(token.content) for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole = re.compile("|".join(added) or "(?!)")
        # Ids that begin with a blank (U+0120 in the library's spelling of bytes).
        entries = self.tokenizer.get_vocab(with_added_tokens=True)
        self.opens = np.zeros(max(entries.values(), default=0) + 1, dtype=bool)
        self.opens[[i for entry, i in entries.items() if entry.startswith("\u0120")]] = True
        self._forget()

    def _forget(self) -> None:
        self.slots: dict[str, int] = {}
        self.flat = array("I")
        self.starts = array("q", [0])
        self.bytes = 0

    def _learn(self, chunks: list[str]) -> None:
        """Ask the tokenizer for chunks: plain ones in one text, which spares an encoding for each, the others by themselves."""
        plain = [chunk for chunk in chunks if PLAIN.fullmatch(chunk) and not self.whole.search(chunk)]
        ids = np.array(self.tokenizer.encode_batch_fast(["".join(plain)], add_special_tokens=False)[0].ids, dtype=np.uint32)
        starts = np.flatnonzero(self.opens[ids])
        # Every plain chunk has one id that begins with a blank, its first; a tokenizer for which this is not so is asked chunk by chunk.
        joined = len(starts) == len(plain) > 0 and starts[0] == 0
        if joined:
            for chunk, own in zip(plain, np.diff(np.r_[starts, len(ids)]).tolist()):
                self._keep(chunk, own)
            self.flat.frombytes(ids.tobytes())
        rest = [chunk for chunk in chunks if chunk not in self.slots] if joined else chunks
        for chunk, encoding in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)):
            self._keep(chunk, len(encoding.ids))
            self.flat.extend(encoding.ids)

    def _keep(self, chunk: str, size: int) -> None:
        """Place the next ``size`` ids under a chunk."""
        self.slots[chunk] = len(self.starts) - 1
        self.starts.append(self.starts[-1] + size)
        self.bytes += 180 + len(chunk) + 4 * size

    def _cut(self, text: str) -> list[str]:
        if self.whole.search(text):
            return [text]
        return CUT.split(text) if UNEVEN.search(text) else text.split(" ")

    def encode(self, texts: list[str], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, each with the end id, and their numbers."""
        if self.bytes > REMEMBERED:
            self._forget()
        # A text with an added token is one chunk; otherwise every chunk but the first has its blank.
        cut = [self._cut(t) for t in texts]
        sizes = np.array([len(c) for c in cut])
        first = np.zeros(int(sizes.sum()), dtype=bool)
        first[np.cumsum(sizes) - sizes] = True
        flat = pa.array([chunk for chunks in cut for chunk in chunks], pa.large_string())
        named = pc.if_else(pa.array(first), flat, pc.binary_join_element_wise(pa.scalar("", pa.large_string()), flat, pa.scalar(" ", pa.large_string())))
        coded = named.dictionary_encode()
        chunks = coded.dictionary.to_pylist()
        fresh = [c for c in chunks if c not in self.slots]
        for at in range(0, len(fresh), 5_000):
            self._learn(fresh[at : at + 5_000])
        slots = np.array([self.slots[c] for c in chunks], dtype=np.int64)[coded.indices.to_numpy()]
        starts = np.frombuffer(self.starts, dtype=np.int64)
        lengths = starts[slots + 1] - starts[slots]
        # The end id follows the last chunk of a text.
        ends = np.cumsum(lengths)
        shift = np.repeat(starts[slots] - (ends - lengths), lengths) + np.arange(int(ends[-1]))
        ids = np.frombuffer(self.flat, dtype=np.uint32)[shift]
        # Long chunks, which may be whole texts, are not met again and only fill the memory.
        if any(len(c) > LONGEST for c in fresh):
            del starts
            self._drop([c for c in fresh if len(c) > LONGEST])
        per_text = np.add.reduceat(lengths, np.cumsum(sizes) - sizes)
        return np.insert(ids, np.cumsum(per_text), end_id), per_text + 1


    def _drop(self, chunks: list[str]) -> None:
        """Forget some chunks; the places of their ids count on until the worker forgets everything."""
        for chunk in chunks:
            del self.slots[chunk]
        if self.bytes > REMEMBERED:
            self._forget()


_ENCODERS: dict[str, ChunkEncoder] = {}


def encoder_of(tokenizer_json: str) -> ChunkEncoder:
    """The worker's encoder for a tokenizer; what it has learned serves the worker's next tasks too."""
    if tokenizer_json not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[tokenizer_json] = ChunkEncoder(tokenizer_json)
    return _ENCODERS[tokenizer_json]


def _parts(texts: list[str]) -> Iterator[slice]:
    first = total = 0
    for at, text in enumerate(texts):
        if total and total + len(text) > AT_ONCE:
            yield slice(first, at)
            first, total = at, 0
        total += len(text)
    if len(texts) > first:
        yield slice(first, len(texts))


def encoded(documents: DataFrame, tokenizer_json: str, end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, part, n_tokens, ids) in ascending order of id; ``part`` numbers the ranges."""
    kind = documents.schema[doc_id].dataType.simpleString()
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    spark = documents.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(ranges, "doc_id").sortWithinPartitions("doc_id", "text")
    ordered = ordered.withColumn("part", F.spark_partition_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer_json)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for cut in _parts(texts):
                ids, lengths = encoder.encode(texts[cut], end_id)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.r_[0, np.cumsum(lengths)].astype(np.int32)), pa.array(ids.astype(np.int32))
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[cut], batch.column("part")[cut], pa.array(lengths.astype(np.int64)), lists],
                    names=["doc_id", "part", "n_tokens", "ids"],
                )

    return ordered.mapInArrow(run, f"doc_id {kind}, part int, n_tokens bigint, ids array<int>")


def write_tokens(rows: DataFrame, path: str) -> None:
    """Write encoded rows, a file per range."""
    (
        rows.write.option("parquet.writer.version", "PARQUET_2_0")
        .option("parquet.block.size", ROW_GROUP)
        .option("parquet.page.row.count.limit", PAGE_ROWS)
        .option("parquet.enable.dictionary", "true")
        .option("compression", "zstd")
        .parquet(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        values = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
        ends = lists.offsets.to_numpy()
        sums = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("part"), batch.column("n_tokens"), batch.column("rank"), pa.array(sums, pa.int64())],
            names=["doc_id", "part", "n_tokens", "rank", "ids_crc32"],
        )


def digest(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from written files; ``start`` counts the ids of all documents before.

    Sums of the ranges, a row each, are added up over the ranges, then each range adds its own rows up.
    """
    kind = files.schema["doc_id"].dataType.simpleString()
    # A file is one range in order, so the order of equal ids is the order of reading.
    numbered = files.withColumn("rank", F.monotonically_increasing_id())
    sums = numbered.mapInArrow(_checksums, f"doc_id {kind}, part int, n_tokens bigint, rank bigint, ids_crc32 bigint")
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = F.sum("total").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    totals = totals.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    own = F.sum("n_tokens").over(W.partitionBy("part").orderBy("doc_id", "rank").rowsBetween(W.unboundedPreceding, -1))
    return sums.join(totals, "part").select(
        "doc_id", (F.col("before") + F.coalesce(own, F.lit(0))).alias("start"), "n_tokens", "ids_crc32"
    )
