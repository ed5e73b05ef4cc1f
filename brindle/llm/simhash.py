"""Near duplicates by SimHash fingerprints and multi-index hashing.

A fingerprint has 64 bits; a bit is set if more than half of the hashes of a document's word shingles have it.
Fingerprints within RADIUS (2) bits of each other are linked.  Both 32-bit halves are indexed: of two linked
fingerprints either the upper halves are equal, or the lower ones are, or each half differs in one bit.  So every
fingerprint fetches the table of its upper half, that of its lower half, and those of the upper halves in a ball of
radius 1, of which only those with one bit more are asked, because the other fingerprint of such a pair asks the
other way.  What is fetched is verified by the complete distance.

A crowded table entry (more than CROWD fingerprints with the same half) is not compared member by member.  Its
members are listed under every value within one bit of them that keeps the half, fingerprints outside that reach
the half by one bit under the value reached.  All that are listed under one value lie within one bit of it and so
within two of each other, at most 65 of them, and one star links them.  Two linked ones always meet in such a value.

Only distinct fingerprints are compared, and links are edges of stars or verified pairs; components come from the
distributed union-find.  The rows of a fingerprint that holds a thousandth of all rows or more get their component
through a broadcast of at most FREQUENT rows, all others through a shuffle.

Defined results: null and empty texts and texts without words have fingerprint zero, which is linked like any
other.  Texts shorter than a shingle are one shingle; very long ones are hashed piece by piece.  Rows are the nodes:
repeated rows and rows of one id are linked if their fingerprints are.  A null id is nobody's component; a
component of null ids only is null.  An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.llm._common import stored
from brindle.llm._links import components

WIDTH = 3
SEED = 42
RADIUS = 2
CROWD = 32
FREQUENT = 1_000
#: Shingles that are counted at once.
AT_ONCE = 1 << 17
HALF = 32


def fingerprint(text: bytes, width: int = WIDTH) -> int:
    """The unsigned fingerprint of a text in UTF-8."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = np.r_[0, ends[:-1] + 1]
    width = min(width, len(words))
    spans = list(zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()))
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(spans), AT_ONCE):
        hashes = np.array([xxh64_intdigest(line[a:b], SEED) for a, b in spans[at : at + AT_ONCE]], dtype=">u8")
        counts += np.unpackbits(hashes.view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(spans)).tobytes(), "big")


def fingerprints(documents: DataFrame, width: int = WIDTH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, bits): the fingerprint as a signed 64-bit integer."""
    kind = documents.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            bits = np.fromiter((fingerprint(t.as_py() or b"", width) for t in texts), dtype=np.uint64, count=len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits.view(np.int64))], names=["doc_id", "bits"])

    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, bits bigint")


def _upper(bits: Column) -> Column:
    return F.shiftrightunsigned(bits, HALF)


def _lower(bits: Column) -> Column:
    return bits.bitwiseAND((1 << HALF) - 1)


def _more_above(bits: Column) -> Column:
    """The fingerprint with each single bit of the upper half set (unchanged where it is set already)."""
    masks = [1 << (HALF + k) for k in range(HALF - 1)] + [-(1 << 63)]
    return F.array(*[bits.bitwiseOR(F.lit(mask)) for mask in masks])


def _ball(bits: Column, first: int) -> Column:
    """The fingerprint and all that differ from it in one of the 32 bits from ``first`` on."""
    masks = [-(1 << 63) if first + k == 63 else 1 << (first + k) for k in range(HALF)]
    return F.array(bits, *[bits.bitwiseXOR(F.lit(mask)) for mask in masks])


def links(prints: DataFrame) -> DataFrame:
    """Edges (a, b) that connect all distinct fingerprints ``bits`` within RADIUS of each other."""
    table = prints.select(
        "bits",
        F.explode(
            F.array(
                F.struct(F.lit(1).alias("half"), _upper(F.col("bits")).alias("value")),
                F.struct(F.lit(2).alias("half"), _lower(F.col("bits")).alias("value")),
            )
        ).alias("entry"),
    ).select("entry.half", "entry.value", "bits")
    crowded = stored(table.groupBy("half", "value").agg(F.count("*").alias("n")).where(F.col("n") > CROWD).select("half", "value"), "crowded")
    thin = stored(table.join(crowded, ["half", "value"], "left_anti"), "halves")
    # Upper halves one bit away, by the fingerprint that the ball's value would make.
    reached = prints.select("bits", F.explode(_more_above(F.col("bits"))).alias("made")).where("made <> bits")
    reached = reached.select("bits", "made", F.lit(1).alias("half"), _upper(F.col("made")).alias("value"))
    a, b = (thin.select("half", "value", F.col("bits").alias(side)) for side in "ab")
    same = a.join(b, ["half", "value"]).where("a < b").select("a", "b")
    one_off = reached.select("value", F.col("bits").alias("a")).join(b.where("half = 1").select("value", "b"), "value").select("a", "b")
    verified = same.unionByName(one_off).where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS)
    members = table.join(crowded, ["half", "value"], "left_semi")
    inside = members.select(
        "bits", F.explode(F.when(F.col("half") == 1, _ball(F.col("bits"), 0)).otherwise(_ball(F.col("bits"), HALF))).alias("made")
    )
    outside = reached.join(crowded, ["half", "value"], "left_semi").select("bits", "made")
    # At most 65 distinct fingerprints lie within one bit of a value.
    met = inside.unionByName(outside).groupBy("made").agg(F.collect_set("bits").alias("all")).where(F.size("all") > 1)
    stars = met.select(F.array_min("all").alias("a"), F.explode("all").alias("b")).where("a <> b")
    return verified.unionByName(stars).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(documents: DataFrame, width: int = WIDTH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id): 16 hexadecimal digits, and the smallest id that links reach."""
    rows = stored(fingerprints(documents, width, doc_id, text), "prints")
    classes = stored(rows.groupBy("bits").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "classes")
    named = stored(components(links(classes.select("bits"))).select(F.col("id").alias("bits"), "component"), "components")
    linked = classes.join(named, "bits")
    firsts = linked.groupBy("component").agg(F.min("least").alias("first"))
    linked = linked.join(firsts, "component").select("bits", "first")
    placed = stored(
        classes.join(linked, "bits", "left").select("bits", "n", F.when(F.col("first").isNull(), F.col("least")).otherwise(F.col("first")).alias("component_id")),
        "placed",
    )
    total = placed.agg(F.sum("n")).first()[0] or 0
    # No more than FREQUENT fingerprints can hold that share of the rows.
    frequent = F.broadcast(placed.where(F.col("n") * FREQUENT >= total).select("bits", "component_id"))
    others = placed.where(F.col("n") * FREQUENT < total).select("bits", "component_id")
    joined = rows.join(frequent, "bits").unionByName(rows.join(frequent, "bits", "left_anti").join(others, "bits"))
    return joined.select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")
