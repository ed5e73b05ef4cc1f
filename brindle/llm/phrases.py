"""Collocations: phrases of two and three words that stand together more often than their parts would.

Counting.  A task numbers the words it meets and counts sequences of one to three word ids in a HAT-trie per
language: hash containers (open addressing, keys are the packed ids) under a shallow trie over the first and second
word.  A container that outgrows BURST bursts: one that covers several first words is cut between two of them, one of
a single first word becomes a node over the second word.  When all containers hold more than HELD sequences, whole
subtrees, those with the fewest repetitions first, are spilled as sorted runs; when the numbering is full, all are.
A run is cut into prefix partitions by a hash of language, first and second word, each with the words it uses.  The
partitions are shuffled and merged, and only sequences with LEAST occurrences or more leave the merge: no other one is
a candidate, and every part of a candidate is as frequent as the candidate at least.

Scoring and dropping are joins of the frequent sequences by language and phrase.

A prefix partition holds what the sequences of two first words need, so a very common word or pair is spread or summed
up in the tasks before; its size follows ``spark.sql.shuffle.partitions``.  Arithmetic is exact (38 decimal digits).

Defined results: null and empty texts have no words; a null language is ``und``.  Repeated rows count each.  Very long
texts are counted in blocks that continue each other.  Ties are ordered by the phrase.  An empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from brindle.llm._common import stored, text_of

LEAST = 10
SHARE = 50
TOP = 2_000
UNKNOWN = "und"
SALTS = 64
#: Products take up to 37 decimal digits.
EXACT = (
    "cast(1000000 as decimal(7,0)) * cast(a as decimal(15,0)) * cast(a as decimal(15,0)) "
    "div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))"
)
#: Sequences of a container and of a task's containers, words that a task numbers, bytes of text counted at once.
BURST = 1 << 15
HELD = 1 << 20
NUMBERED = 1 << 18
AT_ONCE = 1_000_000

BITS = 21
MASK = (1 << BITS) - 1
BREAK = 0xFF  # no byte of UTF-8
# Bytes that end a piece.
ENDS_PIECE = b".,;:!?\n\x0b\x0c\r"
TABLE = bytes(BREAK if b in ENDS_PIECE else 0x20 if b == 9 else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
EMPTY = np.int64(-1)
SPREAD = np.uint64(0x9E3779B97F4A7C15)


class Container:
    """A hash table of packed sequences with linear probing."""

    def __init__(self, room: int = 1 << 10) -> None:
        self.keys = np.full(room, EMPTY)
        self.counts = np.zeros(room, dtype=np.int64)
        self.size = self.total = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Add distinct sequences."""
        need = 2 * (self.size + len(keys))
        if need > len(self.keys):
            own_keys, own_counts = self.items()
            self.__init__(1 << int(need).bit_length())
            if len(own_keys):
                self.add(own_keys, own_counts)
        room = len(self.keys)
        slots = ((keys.astype(np.uint64) * SPREAD) >> np.uint64(64 - room.bit_length() + 1)).astype(np.int64)
        self.total += int(counts.sum())
        while len(keys):
            # Of several that claim a free slot one gets it; the others go on with the next slot.
            free = self.keys[slots] == EMPTY
            self.keys[slots[free]] = keys[free]
            placed = self.keys[slots] == keys
            self.size += int((placed & free).sum())
            self.counts[slots[placed]] += counts[placed]
            keys, counts, slots = keys[~placed], counts[~placed], (slots[~placed] + 1) & (room - 1)

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        used = self.keys != EMPTY
        return self.keys[used], self.counts[used]

    def run(self) -> tuple[np.ndarray, np.ndarray]:
        """Sequences in order."""
        keys, counts = self.items()
        order = np.argsort(keys)
        return keys[order], counts[order]


class Trie:
    """Containers in the order of the sequences that they start with."""

    def __init__(self) -> None:
        self.firsts = [0]
        self.containers = [Container()]

    @property
    def size(self) -> int:
        return sum(c.size for c in self.containers)

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Add distinct sequences that are in order."""
        cuts = np.r_[np.searchsorted(keys, self.firsts), len(keys)]
        for place in range(len(self.firsts) - 1, -1, -1):
            first, last = cuts[place], cuts[place + 1]
            if last > first:
                self.containers[place].add(keys[first:last], counts[first:last])
                if self.containers[place].size > BURST:
                    self._burst(place)

    def _burst(self, place: int) -> None:
        keys, counts = self.containers[place].run()
        for shift in (2 * BITS, BITS):
            prefixes = keys >> shift
            inner = np.flatnonzero(np.diff(prefixes)) + 1
            if len(inner):
                wanted = range(BURST // 2, len(keys), BURST // 2)
                cuts = sorted({int(inner[min(np.searchsorted(inner, w), len(inner) - 1)]) for w in wanted})
                starts, ends = [0, *cuts], [*cuts, len(keys)]
                made = []
                for first, last in zip(starts, ends):
                    container = Container(1 << int(2 * (last - first)).bit_length())
                    container.add(keys[first:last], counts[first:last])
                    made.append(container)
                self.containers[place : place + 1] = made
                self.firsts[place : place + 1] = [self.firsts[place], *(int(prefixes[c]) << shift for c in cuts)]
                return

    def spill(self, left: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Take whole subtrees out, those with the fewest repetitions first, until ``left`` sequences remain."""
        size = self.size
        runs = []
        order = sorted(range(len(self.containers)), key=lambda k: self.containers[k].total / max(self.containers[k].size, 1))
        for place in order:
            if size <= left:
                break
            container = self.containers[place]
            size -= container.size
            runs.append((place, container.run()))
            self.containers[place] = Container()
        yield from (run for _, run in sorted(runs, key=lambda r: r[0]))
        if size == 0:
            self.__init__()


class Words(dict):
    """Numbers of words from 1 on; the break is 0."""

    def __init__(self) -> None:
        self.names = [b""]
        self.hashes = [0]
        self[bytes([BREAK])] = 0

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.names)
        self.names.append(word)
        self.hashes.append(zlib.crc32(word))
        return number


def _blocks(raw: bytes) -> Iterator[bytes]:
    """The text in pieces of about AT_ONCE bytes that end at a space."""
    first = 0
    while len(raw) - first > AT_ONCE:
        last = raw.find(b" ", first + AT_ONCE)
        if last < 0:
            break
        yield raw[first:last]
        first = last
    yield raw[first:]


def sequences(ids: np.ndarray, before: int) -> np.ndarray:
    """Packed sequences of one to three ids, without breaks, that end behind the first ``before`` ids; in order."""
    present = ids > 0
    found = [ids[before:][present[before:]] << (2 * BITS)]
    for width in (2, 3):
        first = max(before - width + 1, 0)
        n = len(ids) - width + 1 - first
        if n > 0:
            keys = np.zeros(n, dtype=np.int64)
            whole = np.ones(n, dtype=bool)
            for k in range(width):
                keys |= ids[first + k : first + k + n] << ((2 - k) * BITS)
                whole &= present[first + k : first + k + n]
            found.append(keys[whole])
    keys = np.concatenate(found)
    keys.sort()
    return keys


class Counter:
    """Counts texts and gives runs: (lang, part, words, keys, n_sequences, n_words)."""

    def __init__(self, parts: int) -> None:
        self.parts = parts
        self.words = Words()
        self.tries: dict[str, Trie] = {}
        self.tokens: dict[str, int] = {}

    def count(self, lang: str, texts: list[bytes]) -> Iterator[tuple]:
        trie = self.tries.setdefault(lang, Trie())
        raw = bytes([BREAK]).join(texts).translate(TABLE).replace(bytes([BREAK]), bytes([0x20, BREAK, 0x20]))
        carried = np.zeros(0, dtype=np.int64)
        for block in _blocks(raw):
            found = block.split()
            ids = np.r_[carried, np.fromiter(map(self.words.__getitem__, found), dtype=np.int64, count=len(found))]
            keys = sequences(ids, len(carried))
            self.tokens[lang] = self.tokens.get(lang, 0) + int((ids[len(carried) :] > 0).sum())
            carried = ids[-2:]
            if len(keys):
                starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
                trie.add(keys[starts], np.diff(np.r_[starts, len(keys)]))
            if len(self.words.names) > NUMBERED:
                names = [self.words.names[i] for i in carried.tolist()]
                yield from self.spill(0)
                self.words = Words()
                trie = self.tries.setdefault(lang, Trie())
                carried = np.array([self.words[n] if n else 0 for n in names], dtype=np.int64)
        if sum(t.size for t in self.tries.values()) > HELD:
            yield from self.spill(HELD // 2)

    def spill(self, left: int) -> Iterator[tuple]:
        size = sum(t.size for t in self.tries.values())
        hashes = np.array(self.words.hashes, dtype=np.uint64)
        for lang, trie in list(self.tries.items()):
            runs = list(trie.spill(int(left * trie.size / max(size, 1))))
            if not left:
                del self.tries[lang]
            if runs:
                yield from self._cut(lang, np.concatenate([r[0] for r in runs]), np.concatenate([r[1] for r in runs]), hashes)

    def _cut(self, lang: str, keys: np.ndarray, counts: np.ndarray, hashes: np.ndarray) -> Iterator[tuple]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=1).compress
        ids = np.stack([keys >> (2 * BITS), (keys >> BITS) & MASK, keys & MASK])
        mixed = (hashes[ids[0]] + np.uint64(zlib.crc32(lang.encode()))) * SPREAD ^ hashes[ids[1]]
        part = ((mixed * SPREAD) >> np.uint64(33)) % np.uint64(self.parts)
        order = np.argsort(part, kind="stable")
        part = part[order]
        cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        for first, last in zip(cuts, np.r_[cuts[1:], len(part)]):
            own = order[first:last]
            used, at = np.unique(ids[:, own], return_inverse=True)
            # Number 0 stands for no word in every run.
            if used[0] != 0:
                used, at = np.r_[0, used], at + 1
            columns = np.stack([*at.reshape(3, -1), counts[own]]).astype("<i8")
            names = b" ".join(self.words.names[i] for i in used[1:].tolist())
            # Bytes of equal place stand together, which compresses the empty ones away.
            planes = np.ascontiguousarray(columns.view(np.uint8).reshape(-1, 8).T)
            yield lang, int(part[first]), pack(names), pack(planes.tobytes()), len(own), self.tokens.pop(lang, 0)


RUN = "lang string, part int, words binary, keys binary, n_sequences bigint, n_words bigint"


def _as_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
    names = ["lang", "part", "words", "keys", "n_sequences", "n_words"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def sorted_runs(documents: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Runs of counted sequences, cut by prefix partition."""
    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = documents.select(text_of(text).alias("text"), F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(parts)
        for batch in batches:
            langs = batch.column("lang")
            for name in pc.unique(langs).to_pylist():
                own = batch.column("text").filter(pc.equal(langs, name)).cast(pa.large_binary())
                taken, size = [], 0
                for value in own:
                    taken.append(value.as_py())
                    size += len(taken[-1])
                    if size >= AT_ONCE:
                        yield from map(_as_batch, ([r] for r in counter.count(name, taken)))
                        taken, size = [], 0
                yield from map(_as_batch, ([r] for r in counter.count(name, taken)))
        yield from map(_as_batch, ([r] for r in counter.spill(0)))

    return rows.mapInArrow(run, RUN)


def _merged(runs: list[tuple[bytes, bytes, int]], least: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(phrases, numbers of words, counts) of the sequences that occur ``least`` times in the runs together."""
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    listed = pc.split_pattern(pa.array([unpack(words) for words, _, _ in runs], pa.large_binary()), " ")
    coded = listed.flatten().dictionary_encode()
    numbers = np.split(coded.indices.to_numpy().astype(np.int64) + 1, listed.offsets.to_numpy()[1:-1])
    del listed
    # Three numbers fit one key, or two where a partition has too many words.
    wide = len(coded.dictionary) > MASK
    keys, more, counts = [], [], []
    for (_, packed, n), own in zip(runs, numbers):
        planes = np.frombuffer(unpack(packed), dtype=np.uint8).reshape(8, -1)
        table = np.ascontiguousarray(planes.T).view("<i8").reshape(4, n)
        one, two, three = np.r_[0, own][table[:3]]
        keys.append(one << 32 | two if wide else one << (2 * BITS) | two << BITS | three)
        more.append(three if wide else three[:0])
        counts.append(table[3])
    keys, more, counts = map(np.concatenate, (keys, more, counts))
    order = np.lexsort((more, keys)) if wide else np.argsort(keys)
    new = np.diff(keys[order]) != 0
    if wide:
        new |= np.diff(more[order]) != 0
    starts = np.flatnonzero(np.r_[True, new])
    counts = np.add.reduceat(counts[order], starts)
    kept = counts >= least
    at = order[starts[kept]]
    own = keys[at]
    first = np.stack([own >> 32, own & 0xFFFFFFFF, more[at]] if wide else [own >> (2 * BITS), (own >> BITS) & MASK, own & MASK])
    used = np.unique(first[first > 0])
    names = dict(zip(used.tolist(), coded.dictionary.take(pa.array(used - 1)).to_pylist()))
    phrases = [b" ".join(names[i] for i in row if i) for row in first.T.tolist()]
    return phrases, (first > 0).sum(axis=0), counts[kept]


def frequent_sequences(runs: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, phrase, size, n) of the sequences of one to three words with ``least`` occurrences or more."""
    parts = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = runs.select("part", "lang", "words", "keys", "n_sequences")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Row by row: a batch may hold all of a task's runs, which are taken out as they are needed.
        listed = (tuple(c[i].as_py() for c in batch.columns) for batch in batches for i in range(batch.num_rows))
        for (_, lang), group in groupby(listed, key=lambda row: row[:2]):
            phrases, sizes, counts = _merged([row[2:] for row in group], least)
            texts = pa.array(phrases, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(phrases), pa.string()), texts, pa.array(sizes, pa.int32()), pa.array(counts, pa.int64())],
                names=["lang", "phrase", "size", "n"],
            )

    # By range, because a hash of so few numbers would send several of them to one task.
    together = rows.repartitionByRange(parts, "part").sortWithinPartitions("part", "lang")
    return together.mapInArrow(run, "lang string, phrase string, size int, n bigint")


def collocations(
    documents: DataFrame, least: int = LEAST, share: int = SHARE, top: int = TOP, text: str = "text", lang: str = "lang"
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the best phrases of every language."""
    runs = stored(sorted_runs(documents, text, lang), "runs")
    grams = stored(frequent_sequences(runs, least), "sequences")
    candidates = grams.where("size > 1").withColumnRenamed("n", "a")
    words = F.split("phrase", " ", -1)
    # A longer candidate counts for the shorter ones at its start and at its end.
    longer = candidates.where("size = 3").select(
        "lang", F.explode(F.array(F.slice(words, 1, 2), F.slice(words, 2, 2))).alias("inner"), "a"
    )
    longer = longer.groupBy("lang", F.array_join("inner", " ").alias("phrase")).agg(F.max("a").alias("longest"))
    kept = candidates.join(longer, ["lang", "phrase"], "left").where(
        F.col("longest").isNull() | (100 * F.col("longest") < share * F.col("a"))
    )
    cuts = kept.select(
        "lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"), words.alias("words")
    ).select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("head"),
        F.array_join(F.expr("slice(words, k + 1, size(words) - k)"), " ").alias("rest"),
    )
    heads = grams.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l"))
    rests = grams.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    scores = cuts.join(heads, ["lang", "head"]).join(rests, ["lang", "rest"]).withColumn("score", F.expr(EXACT))
    lowest = scores.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("cut"))
    totals = runs.groupBy("lang").agg(F.sum("n_words").alias("n"))
    order = [F.desc("cut.score"), F.desc("cut.a"), F.col("phrase")]
    # The best of SALTS parts of a language first, so that one task sorts no more than SALTS * top phrases.
    part = F.row_number().over(W.partitionBy("lang", "salt").orderBy(*order))
    best = lowest.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).withColumn("place", part).where(F.col("place") <= top)
    rank = F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")
    ranked = best.withColumn("rank", rank).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "cut.a", "cut.l", "cut.r", "n", "cut.score")
