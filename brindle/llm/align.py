"""Alignment of two tokenizers' tokens on the bytes of a text.

Tokenizer A (byte-level BPE, of the tokenizers library) reads a space and the text, tokenizer B (SentencePiece BPE
with byte fallback) the text, before which it puts a space itself.  The character spans that the libraries report
are the coarse cuts: a token ends at the byte where its last character ends.  Where a span says too little - the next
token starts within the same character, or a byte piece has an empty span - the token's own decoded bytes give the
end.  The installed sentencepiece has no immutable proto any more; ``offset_mapping`` reports the spans that it held.

Neither tokenizer has a token across a single space between two other characters, so texts are cut there into
chunks, and both end a token at each cut.  A worker aligns a chunk once and remembers it; what it remembers is
bounded by bytes (REMEMBERED).  A text is the sequence of its chunks, also for groups, links and the digest.

Counts of linked id pairs are summed over the corpus.  Pairs with a share of at least 1 / FREQUENT of all links, at
most FREQUENT of them, are broadcast; the rows of all other pairs are joined by a shuffle.

Defined results: null and empty texts have no tokens, nor have texts that the tokens' bytes do not give back (those
with the character U+2581, which B writes for a space): zeros and an empty digest.  Rows are counted one by one,
repeated ones, null ids and repeated ids included.  An empty table gives an empty result; other columns are ignored.
Very long texts are aligned chunk by chunk; a chunk without a space is aligned as a whole.
"""

from __future__ import annotations

import gc
import hashlib
import os
import re
from array import array
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm._common import stored

FREQUENT = 100_000
#: Bytes of chunks that a worker remembers, bytes of text that are aligned and chunks that are learned at once.
REMEMBERED = 160_000_000
AT_ONCE = 2_000_000
LEARNED = 1_000
CUT = re.compile(r"(?<=\S) (?=\S)")
UNEVEN = re.compile(r"\s | \s|^ | $")
SPACE = "▁"


def byte_level_alphabet() -> dict[str, int]:
    """Byte-level BPE writes printable bytes as themselves and the others as the characters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(rest)}


def token_ends(begins: np.ndarray, ends: np.ndarray, sizes: np.ndarray, byte_at: np.ndarray) -> np.ndarray:
    """Byte ends of consecutive tokens from their character spans; ``sizes`` are the decoded bytes."""
    within = (begins >= ends) | np.r_[begins[1:] < ends[:-1], False]
    coarse = byte_at[ends]
    # Behind the last token whose span says it all, the decoded bytes are counted.
    places = np.where(within, -1, np.arange(len(ends)))
    last = np.maximum.accumulate(places)
    total = np.cumsum(sizes)
    known = np.where(last >= 0, coarse[last], 0)
    return known + total - np.where(last >= 0, total[last], 0)


class Aligner:
    """Aligns chunks and remembers them."""

    def __init__(self, tokenizer_json: str, model: bytes) -> None:
        # The tasks of an executor share its cores; the library's own threads would take more.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(tokenizer_json)
        self.a.encode_special_tokens = True
        alphabet = byte_level_alphabet()
        self.a_bytes = {i: bytes(alphabet.get(c, 0x3F) for c in token) for token, i in self.a.get_vocab().items()}
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [(i, self.b.id_to_piece(i)) for i in range(len(self.b))]
        if any(SPACE in p.lstrip(SPACE) for _, p in pieces):
            raise ValueError("the model has pieces across white space")
        self.b_bytes = {i: bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in pieces}
        self.a_sizes, self.b_sizes = (np.array([len(t.get(i, b"")) for i in range(max(t) + 1)]) for t in (self.a_bytes, self.b_bytes))
        # Ids as text with the marks that may follow them, by 3 * id + mark.
        self.marked = [f"{i}{mark}" for i in range(max(len(self.a_sizes), len(self.b_sizes))) for mark in ",|;"]
        self.marked_sizes = np.array(list(map(len, self.marked)))
        self._forget()

    def _forget(self) -> None:
        self.slots: dict[str, int] = {}
        self.digests: list[str] = []
        #: Per chunk: tokens of A, tokens of B, groups, links; all zero for a chunk whose bytes do not come back.
        self.numbers = array("q")
        self.pairs = array("q")
        self.starts = array("q", [0])
        self.bytes = 0

    def _learn(self, chunks: list[str]) -> None:
        """Align chunks as one text; several of them must neither start nor end with white space."""
        text = "".join(" " + chunk for chunk in chunks)
        raw = text.encode()
        found_a = self.a.encode(text, add_special_tokens=False)
        found_b = self.b.encode(text[1:], return_type="offset_mapping")
        ids = (found_a.ids, found_b["ids"])
        if any(b"".join(map(table.__getitem__, own)) != raw for table, own in zip((self.a_bytes, self.b_bytes), ids)):
            if len(chunks) > 1:
                half = len(chunks) // 2
                self._learn(chunks[:half])
                self._learn(chunks[half:])
            else:
                self._remember(chunks, [""], np.zeros((1, 4), dtype=np.int64))
            return
        codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
        byte_at = np.r_[0, np.cumsum(1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000))]
        flat = [np.array(own, dtype=np.int64) for own in ids]
        # B's spans do not count the space before the text.
        spans = [np.array(own, dtype=np.int64) for own in (found_a.offsets, found_b["offsets"])]
        spans[1] += 1
        ends = [token_ends(*own.T, table[i], byte_at) for own, i, table in zip(spans, flat, (self.a_sizes, self.b_sizes))]
        # Every place where a token ends closes one link: that of the tokens of A and B that reach it.
        merged = np.sort(np.concatenate(ends), kind="stable")
        both = merged[1:] == merged[:-1]
        places, cuts = merged[np.r_[True, ~both]], merged[1:][both]
        linked = flat[0][np.searchsorted(ends[0], places)] << 32 | flat[1][np.searchsorted(ends[1], places)]
        groups = [np.searchsorted(cuts, e) for e in ends]
        # Ids as text, A's before B's in a group, each with the mark that follows it.
        order = np.argsort(np.concatenate([2 * groups[0], 2 * groups[1] + 1]), kind="stable")
        side = np.repeat([0, 1], [len(g) for g in groups])[order]
        group = np.concatenate(groups)[order]
        closes = np.r_[(group[1:] != group[:-1]) | (side[1:] != side[:-1]), True]
        marked = 3 * np.concatenate(flat)[order] + np.where(closes, 1 + side, 0)
        written = "".join(map(self.marked.__getitem__, marked.tolist()))
        # Places before which a chunk's tokens, groups and links end.
        until = byte_at[np.cumsum([1 + len(chunk) for chunk in chunks])]
        totals = np.stack([np.searchsorted(own, until, side="right") for own in (*ends, cuts, places)]).T
        last = np.cumsum(self.marked_sizes[marked])[totals[:, 0] + totals[:, 1] - 1].tolist()
        digests = [written[first : end - 1] for first, end in zip([0, *last], last)]
        self.pairs.frombytes(linked.tobytes())
        self._remember(chunks, digests, np.diff(totals, axis=0, prepend=0))

    def _remember(self, chunks: list[str], digests: list[str], numbers: np.ndarray) -> None:
        self.slots.update(zip(chunks, count(len(self.slots))))
        self.starts.frombytes((self.starts[-1] + np.cumsum(numbers[:, 3])).tobytes())
        self.digests += digests
        self.numbers.frombytes(numbers.tobytes())
        self.bytes += 250 * len(chunks) + sum(map(len, chunks)) + sum(map(len, digests)) + 8 * int(numbers[:, 3].sum())

    def align(self, texts: list[str]) -> Iterator[tuple[tuple[int, ...], str, np.ndarray, np.ndarray]]:
        """Per text: (tokens of A, of B, groups, links), digest, distinct id pairs (A's id above 32 bits) and their links."""
        if self.bytes > REMEMBERED:
            self._forget()
        cut = [(CUT.split(t) if UNEVEN.search(t) else t.split(" ")) if t else [] for t in texts]
        fresh = dict.fromkeys(c for chunks in cut for c in chunks if c not in self.slots)
        even = [c for c in fresh if not (c[0].isspace() or c[-1].isspace())]
        # The libraries' results are many small lists without cycles, which the collector would visit again and again.
        collecting = gc.isenabled()
        gc.disable()
        for at in range(0, len(even), LEARNED):
            self._learn(even[at : at + LEARNED])
        for chunk in fresh.keys() - set(even):
            self._learn([chunk])
        if collecting:
            gc.enable()
        numbers = np.frombuffer(self.numbers, dtype=np.int64).reshape(-1, 4)
        pairs, starts = (np.frombuffer(x, dtype=np.int64) for x in (self.pairs, self.starts))
        for chunks in cut:
            slots = list(map(self.slots.__getitem__, chunks))
            own = numbers[slots]
            if not slots or not own[:, 0].all():
                yield (0, 0, 0, 0), "", np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
                continue
            digest = hashlib.sha256(";".join(map(self.digests.__getitem__, slots)).encode()).hexdigest()
            at = starts[slots]
            sizes = own[:, 3]
            ends = np.cumsum(sizes)
            linked = pairs[np.repeat(at - (ends - sizes), sizes) + np.arange(ends[-1])]
            yield tuple(own.sum(axis=0).tolist()), digest, *np.unique(linked, return_counts=True)


_ALIGNERS: dict[tuple[str, bytes], Aligner] = {}


def aligner_of(tokenizer_json: str, model: bytes) -> Aligner:
    """The worker's aligner; the chunks it has met serve the worker's next tasks too."""
    if (tokenizer_json, model) not in _ALIGNERS:
        _ALIGNERS.clear()
        _ALIGNERS[tokenizer_json, model] = Aligner(tokenizer_json, model)
    return _ALIGNERS[tokenizer_json, model]


def _parts(sizes: list[int]) -> Iterator[slice]:
    first = total = 0
    for at, size in enumerate(sizes):
        if total and total + size > AT_ONCE:
            yield slice(first, at)
            first, total = at, 0
        total += size
    if len(sizes) > first:
        yield slice(first, len(sizes))


def alignments(documents: DataFrame, tokenizer_json: str, model: bytes, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times): a text's id pairs and their links."""
    kind = documents.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = aligner_of(tokenizer_json, model)
        for batch in batches:
            for part in _parts(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()):
                own = batch[part]
                found = list(aligner.align([t or "" for t in own.column("text").to_pylist()]))
                numbers = np.array([f[0] for f in found], dtype=np.int64).reshape(-1, 4)
                offsets = pa.array(np.cumsum([0, *(len(f[2]) for f in found)]).astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([f[k] for f in found]).astype(np.int64))) for k in (2, 3)]
                yield pa.RecordBatch.from_arrays(
                    [own.column("row"), own.column("doc_id"), *map(pa.array, numbers.T), pa.array([f[1] for f in found], pa.string()), *lists],
                    names=["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"],
                )

    rows = documents.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(
        run,
        f"row bigint, doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
        "pairs array<bigint>, times array<bigint>",
    )


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, a, b, n, best): links of each id pair in the corpus, and whether no pair of its B id has more."""
    linked = aligned.select(F.inline(F.arrays_zip("pairs", "times")))
    counts = stored(linked.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("n")), "pair-counts")
    counts = counts.select("pair", F.shiftright("pair", 32).alias("a"), F.col("pair").bitwiseAND((1 << 32) - 1).alias("b"), "n")
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(most, "b").select("pair", "a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def scored(documents: DataFrame, tokenizer_json: str, model: bytes, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row."""
    aligned = stored(alignments(documents, tokenizer_json, model, doc_id, text), "alignments")
    counts = stored(pair_counts(aligned).select("pair", "n", F.col("best").cast("long").alias("best")), "pairs")
    total = counts.agg(F.sum("n")).first()[0] or 0
    # At most FREQUENT pairs can have that share of the links.
    frequent = F.broadcast(counts.where(F.col("n") * FREQUENT >= total))
    linked = aligned.select("row", F.inline(F.arrays_zip("pairs", "times"))).withColumnRenamed("pairs", "pair")
    sums = [F.sum(F.col("times") * F.col(c)).alias(c) for c in ("n", "best")]
    # All pairs of a row are in one task, so the first sum leaves one record per row and the rare pairs.
    common = linked.join(frequent, "pair").groupBy("row").agg(*sums)
    others = counts.where(F.col("n") * FREQUENT < total)
    rare = linked.join(frequent, "pair", "left_anti").join(others, "pair").groupBy("row").agg(*sums)
    both = common.unionByName(rare).groupBy("row").agg(F.sum("n").alias("n"), F.sum("best").alias("best"))
    return aligned.drop("pairs", "times").join(both, "row", "left").select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        F.coalesce("best", F.lit(0)).alias("n_best"),
        F.coalesce("n", F.lit(0)).alias("count_sum"),
        "groups_sha256",
    )
