"""Interpolated modified Kneser-Ney bigram model, counted in Spark, stored as sorted arrays, read by memory mapping.

Words are 64-bit hashes.  A first pass counts them; the sorted hashes of all training words are the vocabulary
and a word's place in it is its number.  A second pass counts pairs of numbers (a 64-bit key, exact).  Counts are
added up inside a task first, then per shard of the key space, so a frequent word is no hot spot: pairs are dealt
by a mix of both words.  Each shard is written as sorted raw arrays; workers map the files
and look a batch up by binary search in sorted order.

The files go to a folder that is mounted on every machine (``spark.checkpoint.dir`` with a file path, or
``folder``); they appear under their final name only when complete, so a task that runs twice does no harm.

Two different words share a hash by chance with a probability of about n ** 2 / 2 ** 65 for n different words.

Defined results: null and empty texts are one end token.  Without training tokens every probability is that
of an unknown word.  Repeated rows count each.  A null id is in training.  Other columns are ignored.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.llm._common import ascii_lower, stored, text_of, words
from brindle.session import work_path

FOLDS, HELD_OUT = 7, 2
#: Distinct keys a task gathers before it hands them on, tokens scored at once.
GATHERED = 3_000_000
AT_ONCE = 1_000_000
MIX = np.uint64(0x9E3779B97F4A7C15)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == HELD_OUT, F.lit(False))


def hashed(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, held_out, hashes): a hash per word."""
    rows = documents.select(F.col(doc_id).alias("doc_id"), words(ascii_lower(text_of(text))).alias("words"))
    return rows.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.transform("words", lambda w: F.xxhash64(w)).alias("hashes")
    )


def _mixed(keys: np.ndarray, shards: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        mixed = keys.astype(np.uint64) * MIX
    return ((mixed >> np.uint64(33)) % np.uint64(shards)).astype(np.int64)


def _added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and their summed counts."""
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(count, first) if len(key) else count


def _packed(keys: np.ndarray, counts: np.ndarray, shards: int, of) -> Iterator[pa.RecordBatch]:
    """A row per shard with the sorted keys and their counts as bytes."""
    shard = of(keys, shards)
    order = np.argsort(shard, kind="stable")
    cuts = np.searchsorted(shard[order], np.arange(shards + 1))
    rows = [(s, order[a:b]) for s, a, b in zip(range(shards), cuts[:-1], cuts[1:]) if b > a]
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([s for s, _ in rows], pa.int32()),
            pa.array([keys[own].tobytes() for _, own in rows], pa.binary()),
            pa.array([counts[own].astype(np.int64).tobytes() for _, own in rows], pa.binary()),
        ],
        names=["shard", "keys", "counts"],
    )


def _counted(rows: DataFrame, shards: int, keys_of, of) -> DataFrame:
    """(shard, keys, counts) of what ``keys_of`` makes of a batch, added up per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, size = [], [], 0
        make = keys_of()
        for batch in batches:
            own = make(batch)
            key, count = np.unique(own, return_counts=True)
            keys.append(key)
            counts.append(count.astype(np.int64))
            size += len(key)
            if size > GATHERED:
                key, count = _added(keys, counts)
                if len(key) > GATHERED // 2:
                    yield from _packed(key, count, shards, of)
                    keys, counts, size = [], [], 0
                else:
                    keys, counts, size = [key], [count], len(key)
        if keys:
            yield from _packed(*_added(keys, counts), shards, of)

    return rows.mapInArrow(run, "shard int, keys binary, counts binary")


def _lists(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    column = batch.column("hashes")
    ends = column.offsets.to_numpy()
    return column.values.slice(ends[0], ends[-1] - ends[0]).to_numpy(zero_copy_only=False), np.diff(ends)


def _write(folder: str, name: str, values: np.ndarray) -> None:
    path = os.path.join(folder, name)
    # Attempts of a task on two machines must not share a name.
    own = f"{path}.{uuid.uuid4().hex}"
    with open(own, "wb") as out:
        values.tofile(out)
    os.replace(own, path)


def _mapped(folder: str, name: str, kind) -> np.ndarray:
    path = os.path.join(folder, name)
    return np.memmap(path, dtype=kind, mode="r") if os.path.exists(path) and os.path.getsize(path) else np.zeros(0, kind)


def _shards_of(counted: DataFrame, shards: int, write, schema: str) -> DataFrame:
    """One task per shard adds its parts up; ``write(shard, keys, counts)`` returns columns of result rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list] = {}
        for batch in batches:
            for s, k, c in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                own = parts.setdefault(s, [])
                own.append((np.frombuffer(k.as_buffer(), np.int64), np.frombuffer(c.as_buffer(), np.int64)))
                if len(own) > 32:
                    own[:] = [_added([k for k, _ in own], [c for _, c in own])]
        for s, own in parts.items():
            yield from write(s, *_added([k for k, _ in own], [c for _, c in own]))

    dealt = counted.repartition(shards, "shard")
    return dealt.mapInArrow(run, schema)


def _by_range(keys: np.ndarray, shards: int) -> np.ndarray:
    """Equal ranges of the signed 64-bit space, so that shards in order hold the keys in order."""
    return ((keys.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)) // np.uint64((1 << 64) // shards + 1)).astype(np.int64)


def _discounts(n: list[int]) -> list[float]:
    """D1, D2, D3+ from the numbers of keys counted once to four times; 0.5, 1, 1.5 where they are not defined."""
    if min(n) <= 0:
        return [0.5, 1.0, 1.5]
    y = n[0] / (n[0] + 2 * n[1])
    values = [k + 1 - (k + 2) * y * n[k + 1] / n[k] for k in range(3)]
    return [float(min(max(v, 0.0), k + 1)) for k, v in enumerate(values)]


class Model:
    """Arrays of a trained model, mapped from its folder."""

    def __init__(self, about: dict) -> None:
        self.about = about
        folder, shards = about["folder"], about["shards"]
        parts = [_mapped(folder, f"words-{s}", np.int64) for s in range(shards)]
        self.first = np.cumsum([0, *(len(p) for p in parts)])
        self.words = parts
        self.word_counts = [_mapped(folder, f"counts-{s}", np.int64) for s in range(shards)]
        self.context = [_mapped(folder, f"context-{s}", np.float64) for s in range(shards)] if about.get("pairs") else None
        self.pairs = [(_mapped(folder, f"pairs-{s}", np.int64), _mapped(folder, f"pair-counts-{s}", np.int32)) for s in range(shards)] if about.get("pairs") else None

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of words, -1 for unknown ones."""
        distinct, back = np.unique(hashes, return_inverse=True)
        out = np.full(len(distinct), -1, dtype=np.int64)
        shard = _by_range(distinct, len(self.words))
        cuts = np.searchsorted(shard, np.arange(len(self.words) + 1))
        for s, words_ in enumerate(self.words):
            own = distinct[cuts[s] : cuts[s + 1]]
            if len(own) and len(words_):
                at = np.minimum(np.searchsorted(words_, own), len(words_) - 1)
                out[cuts[s] : cuts[s + 1]] = np.where(words_[at] == own, at + self.first[s], -1)
        return out[back]

    def _values(self, arrays: list[np.ndarray], numbers: np.ndarray, width: int) -> np.ndarray:
        distinct, back = np.unique(numbers, return_inverse=True)
        out = np.zeros((len(distinct), width))
        cuts = np.searchsorted(distinct, self.first)
        for s, values in enumerate(arrays):
            own = slice(cuts[s], cuts[s + 1])
            if cuts[s + 1] > cuts[s] and len(values):
                out[own] = np.asarray(values).reshape(-1, width)[distinct[own] - self.first[s]]
        return out[back]

    def counts(self, numbers: np.ndarray) -> np.ndarray:
        return self._values(self.word_counts, numbers, 1)[:, 0]

    def pair_counts(self, keys: np.ndarray) -> np.ndarray:
        distinct, back = np.unique(keys, return_inverse=True)
        out = np.zeros(len(distinct))
        shard = _mixed(distinct, len(self.pairs))
        order = np.argsort(shard, kind="stable")
        cuts = np.searchsorted(shard[order], np.arange(len(self.pairs) + 1))
        for s, (known, counts) in enumerate(self.pairs):
            own = order[cuts[s] : cuts[s + 1]]
            if len(own) and len(known):
                at = np.minimum(np.searchsorted(known, distinct[own]), len(known) - 1)
                out[own] = np.where(known[at] == distinct[own], counts[at], 0)
        return out[back]

    def log10(self, before: np.ndarray, word: np.ndarray) -> np.ndarray:
        """log10 p(word | before) by numbers; ``size`` stands for begin (before) and end (word), -1 for unknown."""
        a = self.about
        size = a["size"]
        # Context columns: pairs that start with it (tokens, seen once, twice, more often), pairs that end with it.
        left = self._values(self.context, np.where(before < 0, size + 2, before), 5)
        right = self._values(self.context, np.where(word < 0, size + 2, word), 5)[:, 4]
        right = np.where(word == size, a["end_lefts"], right)
        left = np.where((before == size)[:, None], np.array([*a["begin"], 0.0]), left)
        d, low = np.array(a["discounts"]), np.array(a["low_discounts"])
        cut = lambda count, by: np.maximum(count - by[np.clip(count.astype(int), 1, 3) - 1], 0) * (count > 0)
        total = max(a["types"], 1)
        lower = cut(right, low) / total + a["low_rest"] / (size + 2)
        pair = self.pair_counts(np.where((before < 0) | (word < 0), -1, before * (size + 1) + word))
        tokens = np.maximum(left[:, 0], 1)
        high = cut(pair, d) / tokens
        rest = np.where(left[:, 0] > 0, left[:, 1:4] @ d / tokens, 1.0)
        return np.log10(np.maximum(high + rest * lower, 1e-300))


def _pair_keys(model: Model, batch: pa.RecordBatch) -> np.ndarray:
    hashes, lengths = _lists(batch)
    before, word = _sequence(model.numbers(hashes), lengths, model.about["size"])
    return before * (model.about["size"] + 1) + word


def _sequence(numbers: np.ndarray, lengths: np.ndarray, edge: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's words with an end, and what stands before each, with a begin."""
    at = np.cumsum(lengths)
    return np.insert(numbers, at - lengths, edge), np.insert(numbers, at, edge)


def train(documents: DataFrame, folder: str | None = None, doc_id: str = "doc_id", text: str = "text") -> dict:
    """Count, write the model's files, and return its few numbers (``Model`` maps the files)."""
    spark = documents.sparkSession
    path = urlparse(folder or work_path(spark, "kneser-ney"))
    if path.scheme not in ("", "file"):
        raise ValueError("the model's folder has to be mounted on every machine: pass `folder` with a file path")
    folder = path.path
    os.makedirs(folder, exist_ok=True)
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = hashed(documents, doc_id, text).where("not held_out").select("hashes")
    n_texts = rows.count()

    def write_words(s: int, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        _write(folder, f"words-{s}", keys)
        _write(folder, f"counts-{s}", counts)
        yield pa.RecordBatch.from_arrays([pa.array([len(keys)]), pa.array([int(counts.sum())])], names=["types", "tokens"])

    words_counted = _counted(rows, shards, lambda: lambda batch: _lists(batch)[0], _by_range)
    sums = stored(_shards_of(words_counted, shards, write_words, "types bigint, tokens bigint"), "lm-words")
    size, tokens = sums.agg(F.coalesce(F.sum("types"), F.lit(0)), F.coalesce(F.sum("tokens"), F.lit(0))).first()
    about = {"folder": folder, "shards": shards, "size": int(size), "tokens": int(tokens) + n_texts, "texts": n_texts}
    if size >= 1 << 31:
        raise ValueError("pair keys hold vocabularies of up to 2 ** 31 words")
    base = dict(about)

    def pair_keys():
        model = Model(base)
        return lambda batch: _pair_keys(model, batch)

    def write_pairs(s: int, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        _write(folder, f"pairs-{s}", keys)
        if counts.max(initial=0) >= 1 << 31:
            raise ValueError("a pair occurs 2 ** 31 times or more")
        _write(folder, f"pair-counts-{s}", counts.astype(np.int32))
        # What the shard knows of each word: as the first of a pair, and as the second.
        first, second = keys // (size + 1), keys % (size + 1)
        word, at = np.unique(np.r_[first, second], return_inverse=True)
        table = np.zeros((len(word), 5), dtype=np.int64)
        a, b = at[: len(keys)], at[len(keys) :]
        np.add.at(table, (a, np.zeros(len(a), int)), counts)
        np.add.at(table, (a, np.minimum(counts, 3)), 1)
        np.add.at(table, (b, np.full(len(b), 4)), 1)
        own = np.searchsorted(bounds, word, side="right") - 1
        cuts = np.searchsorted(own, np.arange(shards + 2))
        times = [int((counts == k).sum()) for k in (1, 2, 3, 4)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([i for i in range(shards + 1)], pa.int32()),
                pa.array([word[x:y].tobytes() for x, y in zip(cuts[:-1], cuts[1:])], pa.binary()),
                pa.array([table[x:y].tobytes() for x, y in zip(cuts[:-1], cuts[1:])], pa.binary()),
                *[pa.array([t if i == 0 else 0 for i in range(shards + 1)], pa.int64()) for t in times],
            ],
            names=["shard", "keys", "counts", "n1", "n2", "n3", "n4"],
        )

    bounds = np.r_[Model(base).first[:-1], size]  # shard `shards` holds the begin and end marks
    pairs_counted = _counted(rows, shards, pair_keys, _mixed)
    schema = "shard int, keys binary, counts binary, n1 bigint, n2 bigint, n3 bigint, n4 bigint"
    parts = stored(_shards_of(pairs_counted, shards, write_pairs, schema), "lm-pairs")
    ranges = bounds.tolist()

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[int, np.ndarray] = {}
        for batch in batches:
            for s, k, c in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                width = (ranges[s + 1] if s < len(ranges) - 1 else ranges[-1] + 1) - ranges[s]
                table = tables.setdefault(s, np.zeros((width, 5)))
                table[np.frombuffer(k.as_buffer(), np.int64) - ranges[s]] += np.frombuffer(c.as_buffer(), np.int64).reshape(-1, 5)
        for s, table in tables.items():
            if s < shards:
                _write(folder, f"context-{s}", table)
            lefts = table[:, 4].astype(np.int64)
            edge = table[0].tolist() if s == shards else [0.0] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(lefts.sum())])] + [pa.array([int((lefts == k).sum())]) for k in (1, 2, 3, 4)] + [pa.array([int((lefts > 2).sum())])] + [pa.array([float(v)]) for v in edge],
                names=["types", "n1", "n2", "n3", "n4", "n3plus", *[f"edge{i}" for i in range(5)]],
            )

    fields = "types bigint, n1 bigint, n2 bigint, n3 bigint, n4 bigint, n3plus bigint, " + ", ".join(f"edge{i} double" for i in range(5))
    low = stored(parts.select("shard", "keys", "counts").repartition(shards + 1, "shard").mapInArrow(gather, fields), "lm-context")
    of_pairs = parts.agg(*[F.coalesce(F.sum(f"n{k}"), F.lit(0)) for k in (1, 2, 3, 4)]).first()
    of_low = low.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in low.columns]).first()
    d, low_d = _discounts(list(of_pairs)), _discounts(list(of_low[1:5]))
    types = int(of_low[0])
    rest = (low_d[0] * of_low[1] + low_d[1] * of_low[2] + low_d[2] * of_low[5]) / types if types else 1.0
    edge = list(of_low[6:])
    return about | {
        "pairs": True, "types": types, "discounts": d, "low_discounts": low_d, "low_rest": float(rest), "begin": edge[:4], "end_lefts": edge[4],
    }


def scored(documents: DataFrame, about: dict, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score): log10 probabilities of whole texts."""
    kind = documents.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(about)
        size = about["size"]
        distinct = size + (about["texts"] > 0)
        for whole in batches:
            ends = whole.column("hashes").offsets.to_numpy()
            first = 0
            while first < len(whole):
                last = min(max(first + 1, int(np.searchsorted(ends, ends[first] + AT_ONCE, side="right")) - 1), len(whole))
                batch = whole.slice(first, last - first)
                first = last
                hashes, lengths = _lists(batch)
                before, word = _sequence(model.numbers(hashes), lengths, size)
                counts = np.where(word == size, about["texts"], model.counts(np.where(word < 0, size + 2, word)))
                base = np.log10((counts + 1) / (about["tokens"] + distinct + 1))
                cuts = np.r_[0, np.cumsum(lengths + 1)[:-1]]
                add = lambda values: pa.array(np.add.reduceat(values, cuts))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"), batch.column("held_out"), pa.array((lengths + 1).astype(np.int64)),
                        add((counts > 0).astype(np.int64)), pa.array(np.full(len(lengths), about["tokens"], np.int64)),
                        add(base), add(model.log10(before, word)),
                    ],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    schema = f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return hashed(documents, doc_id, text).mapInArrow(run, schema)
