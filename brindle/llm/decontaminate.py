"""Benchmark decontamination through a distributed positional inverted index.

The index holds, for every term of the benchmark, where it stands in the training documents: rows of
(term, docs, positions) per block of documents, built where the documents are and written without a shuffle.
A window is a run of SIZE words of a benchmark item.  Its rarest terms in the corpus are looked up, their
lists are shifted by the term's offset and intersected, and what is left is compared word by word with the
document.  ``near`` returns places where the rarest terms meet within a slop instead.

Terms travel to the tasks as sorted hashes, BLOCK of them at a time, so what a task holds is bounded for any
size of the benchmark; a larger one makes more passes over the documents.

Defined results: null and empty texts have no words and no hits; an item without words has no window, one of
fewer than SIZE words is a single window.  Rows equal in id and text get equal results.  Equal windows of several items count
for all of them.  Null item ids match but are not listed.  Empty tables give no hits.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from brindle.llm._common import ascii_lower, stored, text_of, words

#: Everything between words: ASCII characters other than letters and digits.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SIZE = 13
ANCHORS = 2
BLOCK = 1 << 20
TOKENS_AT_ONCE = 2_000_000


def tokens(text: Column) -> Column:
    return words(ascii_lower(text), BETWEEN)


def windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct windows: (window, words, items); ``items`` are the ids that contain it, sorted, as strings."""
    rows = benchmark.select(F.col(item_id).cast("string").alias("item"), tokens(text_of(text)).alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (SIZE - 1), F.lit(1)))
    runs = rows.select("item", F.explode(F.transform(starts, lambda at: F.slice("words", at, F.lit(SIZE)))).alias("words"))
    return runs.groupBy("words").agg(F.sort_array(F.collect_set("item")).alias("items")).select(
        F.xxhash64("words").alias("window"), "words", "items"
    )


def keyed(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, key, words); the key stands for a row's id and text."""
    return documents.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(doc_id), F.col(text)).alias("key"), tokens(text_of(text)).alias("words")
    )


def _inverted(keys: np.ndarray, lengths: np.ndarray, hashes: np.ndarray, terms: np.ndarray) -> pa.RecordBatch:
    """Positional lists of the known terms of a few documents, a row per term."""
    at = np.minimum(np.searchsorted(terms, hashes), len(terms) - 1)
    known = np.flatnonzero(terms[at] == hashes)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    doc = np.searchsorted(starts, known, side="right") - 1
    order = np.argsort(at[known], kind="stable")
    term, doc, place = at[known][order], doc[order], known[order]
    cuts = np.flatnonzero(np.r_[True, term[1:] != term[:-1]]) if len(term) else np.zeros(0, int)
    offsets = pa.array(np.r_[cuts, len(term)].astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(terms[term[cuts]] if len(term) else np.zeros(0, np.int64)),
            pa.ListArray.from_arrays(offsets, pa.array(keys[doc])),
            pa.ListArray.from_arrays(offsets, pa.array((place - starts[doc]).astype(np.int32))),
        ],
        names=["term", "docs", "positions"],
    )


def index(keyed_documents: DataFrame, terms: list[int]) -> DataFrame:
    """(term, docs, positions) of the given terms, by hash; several rows per term, one per block of documents."""
    wanted = np.sort(np.array(terms, dtype=np.int64))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            lists = batch.column(1)
            ends = lists.offsets.to_numpy()
            first = 0
            while first < len(keys):
                last = max(first + 1, int(np.searchsorted(ends, ends[first] + TOKENS_AT_ONCE, side="right")) - 1)
                last = min(last, len(keys))
                hashes = lists.values.slice(ends[first], ends[last] - ends[first]).to_numpy(zero_copy_only=False)
                yield _inverted(keys[first:last], np.diff(ends[first : last + 1]), hashes, wanted)
                first = last

    hashed = keyed_documents.select("key", F.transform("words", lambda word: F.xxhash64(word)).alias("hashes"))
    return hashed.mapInArrow(build, "term bigint, docs array<bigint>, positions array<int>")


def stored_index(keyed_documents: DataFrame, runs: DataFrame) -> DataFrame:
    """The index of all terms of the windows, written to the shared folder."""
    vocabulary = stored(
        runs.select(F.explode("words").alias("word")).distinct().select(F.xxhash64("word").alias("term")).distinct(), "terms"
    )
    blocks = -(-vocabulary.count() // BLOCK)
    parts = [
        stored(
            index(
                keyed_documents,
                [row.term for row in vocabulary.where(F.pmod(F.xxhash64("term"), F.lit(blocks)) == block).toLocalIterator()] or [0],
            ),
            "index",
        )
        for block in range(max(blocks, 1))
    ]
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    return table


def anchors(runs: DataFrame, postings: DataFrame) -> DataFrame:
    """(window, term, offset, n_anchors): the rarest terms of each window, all of whose terms occur in the corpus."""
    counts = postings.groupBy("term").agg(F.sum(F.size("positions")).alias("n"))
    placed = runs.select("window", F.size("words").alias("size"), F.posexplode("words").alias("offset", "word"))
    ranked = placed.withColumn("term", F.xxhash64("word")).join(counts, "term")
    window = W.partitionBy("window")
    ranked = ranked.select(
        "window", "term", "offset", "size",
        F.count("*").over(window).alias("present"),
        F.row_number().over(window.orderBy("n", "term", "offset")).alias("rank"),
    )
    return ranked.where((F.col("present") == F.col("size")) & (F.col("rank") <= ANCHORS)).select(
        "window", "term", "offset", F.least("size", F.lit(ANCHORS)).alias("n_anchors")
    )


def _shifted(postings: DataFrame, chosen: DataFrame) -> DataFrame:
    """(window, key, start, offset, n_anchors): lists of the anchors, moved by their offset."""
    lists = postings.join(chosen.select("term").distinct(), "term", "left_semi")
    rows = lists.select("term", F.explode(F.arrays_zip("docs", "positions")).alias("at")).select(
        "term", F.col("at.docs").alias("key"), F.col("at.positions").alias("position")
    )
    return rows.join(chosen, "term").select(
        "window", "key", (F.col("position") - F.col("offset")).alias("start"), "offset", "n_anchors"
    )


def candidates(postings: DataFrame, chosen: DataFrame) -> DataFrame:
    """(window, key, start) where all anchors of a window stand at their offsets."""
    cells = _shifted(postings, chosen).where("start >= 0")
    met = cells.groupBy("window", "key", "start", "n_anchors").agg(F.countDistinct("offset").alias("n"))
    return met.where("n = n_anchors").select("window", "key", "start")


def near(
    documents: DataFrame, benchmark: DataFrame, slop: int = SIZE,
    doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
) -> DataFrame:
    """Proximity matches (doc_id, item): the rarest terms of a window of the item stand within ``slop`` words of their offsets."""
    rows = keyed(documents, doc_id, text)
    runs = stored(windows(benchmark, item_id, text), "windows")
    postings = stored_index(rows, runs)
    cells = _shifted(postings, anchors(runs, postings))
    # Starts at most ``slop`` apart fall into one cell or two neighbouring ones.
    cell = F.floor(F.col("start") / (slop + 1))
    cells = cells.select("window", "key", "offset", "n_anchors", "start", F.explode(F.array(cell, cell + 1)).alias("cell"))
    places = cells.groupBy("window", "key", "cell", "n_anchors", "offset").agg(F.collect_set("start").alias("starts"))
    pair = places.groupBy("window", "key", "cell", "n_anchors").agg(F.collect_list("starts").alias("sides"))
    close = F.exists(
        F.get("sides", F.lit(0)), lambda x: F.exists(F.get("sides", F.lit(1)), lambda y: F.abs(x - y) <= slop)
    )
    met = pair.where((F.size("sides") == F.col("n_anchors")) & ((F.col("n_anchors") == 1) | close))
    pairs = met.select("window", "key").distinct().join(runs, "window").select("key", F.explode("items").alias("item"))
    return rows.select("doc_id", "key").join(pairs, "key").select("doc_id", "item").distinct()


def contamination(
    documents: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """Per row (doc_id, key, n_words, n_hit, items): words inside an occurring window, and the items with one."""
    rows = keyed(documents, doc_id, text)
    runs = stored(windows(benchmark, item_id, item_text), "windows")
    postings = stored_index(rows, runs)
    chosen = stored(anchors(runs, postings), "anchors")
    placed = stored(candidates(postings, chosen), "candidates").join(runs, "window")
    by_key = placed.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "words", "items"))).alias("places"))
    # Words that are used once would be evaluated inside the filter, for every place again.
    exact = F.when(
        F.size("words") > 0,
        F.filter("places", lambda p: F.slice("words", p["start"] + 1, F.size(p["words"])) == p["words"]),
    )
    # Only the text of rows with a candidate travels to the places, and not its words, which take more room.  The rows
    # learn that from a list of keys; one that is too long for a broadcast leaves them where the places come to as well.
    met = stored(placed.select("key").distinct(), "met").withColumn("met", F.lit(True))
    texts = documents.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(doc_id), F.col(text)).alias("key"), F.col(text).alias("text"))
    counted = texts.join(met, "key", "left").select(
        "doc_id", "key", F.size(tokens(text_of("text"))).alias("n_words"), F.when(F.col("met"), F.col("text")).alias("text")
    )
    split = counted.join(by_key, "key", "left").select("doc_id", "key", "n_words", tokens(text_of("text")).alias("words"), "places")
    joined = split.select("doc_id", "key", "n_words", exact.alias("places"))
    spans = F.transform("places", lambda p: F.struct(p["start"].alias("start"), (p["start"] + F.size(p["words"])).alias("end")))
    covered = F.aggregate(
        spans,
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda done, span: F.struct(
            (done["n"] + F.greatest(span["end"] - F.greatest(done["end"], span["start"]), F.lit(0))).alias("n"),
            F.greatest(done["end"], span["end"]).alias("end"),
        ),
        lambda done: done["n"],
    )
    items = F.sort_array(F.array_distinct(F.flatten(F.transform("places", lambda p: p["items"]))))
    return joined.select(
        "doc_id",
        "key",
        F.col("n_words").cast("long"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(items, F.array().cast("array<string>")).alias("items"),
    )


def summary(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
    )


def is_contaminated() -> Column:
    """A twentieth of the words or more are in benchmark windows."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
