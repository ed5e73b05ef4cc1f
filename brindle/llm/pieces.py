"""SentencePiece encoding and decoding for a BPE model with byte fallback, by suffix-array matching.

The units (a word with the white space before it) that a batch of texts has and the worker has not met yet are
written one after the other and indexed by a suffix array, sorted by as many characters as the longest piece
has.  A binary search gives every piece its range of occurrences; these edges are sorted by position.  Where
no edge crosses a place the text falls into independent segments.  A BPE model does not ask for the best path
but for the best merge next, so relaxing the edges means: in each round every segment takes its best-scored
edge that joins two neighbouring symbols, leftmost first, until none is left.

Results equal the library's own ``encode`` for models with identity normalisation, a dummy prefix, and no
piece that continues across white space; other models are refused.

Defined results: null and empty texts have no ids and decode to the empty string.  Rows are independent.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
UNIT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
END = 0x110000
#: Bytes of units and ids that a worker remembers, characters that are indexed at once.
REMEMBERED = 160_000_000
INDEXED = 600_000
#: Segments with more characters than this are relaxed by a heap of edges, shorter ones in rounds over all of them.
LONG = 256


@dataclass(frozen=True)
class Model:
    """Pieces by id with their scores; kind is 'n' for normal pieces, 'b' for bytes, 'c' for the others."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: str


def load(model_file: str) -> Model:
    """The model's tables, read once on the driver and sent to the tasks."""
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=model_file)
    ids = range(len(processor))
    kind = lambda i: "b" if processor.is_byte(i) else "c" if processor.is_control(i) or processor.is_unknown(i) or processor.is_unused(i) else "n"
    model = Model(
        tuple(processor.id_to_piece(i) for i in ids), tuple(processor.get_score(i) for i in ids), "".join(map(kind, ids))
    )
    probe = " ﬁ  x"
    if processor.decode(processor.encode(probe)) != probe or processor.encode("x") != processor.encode("x ")[:1]:
        raise ValueError("the model normalises its text")
    if any(SPACE in p.lstrip(SPACE) for p, k in zip(model.pieces, model.kinds) if k == "n") or model.kinds.count("b") != 256:
        raise ValueError("the model has pieces across white space or no byte pieces")
    return model


class Encoder:
    """Encodes batches of texts; remembers units it has met."""

    def __init__(self, model: Model) -> None:
        normal = [i for i, kind in enumerate(model.kinds) if kind == "n"]
        self.ids = np.array(normal, dtype=np.int64)
        self.lengths = np.array([len(model.pieces[i]) for i in normal])
        self.longest = int(self.lengths.max())
        self.codes = np.full((len(normal), self.longest), -1, dtype=np.int32)
        for row, i in enumerate(normal):
            self.codes[row, : self.lengths[row]] = [ord(c) for c in model.pieces[i]]
        # Place of a piece in the order of merges: best score first.
        scores = np.array([model.scores[i] for i in normal])
        self.places = np.unique(-scores, return_inverse=True)[1].astype(np.int64)
        self.byte_ids = [i for i, kind in enumerate(model.kinds) if kind == "b"]
        self.known: dict[str, bytes] = {}
        self.bytes = 0

    def suffixes(self, codes: np.ndarray) -> np.ndarray:
        """Positions in the order of the ``longest`` characters that follow them."""
        rank = np.unique(codes, return_inverse=True)[1].astype(np.int64)
        width = 1
        while width < self.longest:
            after = np.zeros_like(rank)
            after[:-width] = rank[width:] + 1
            rank = np.unique(rank * (int(rank.max()) + 2) + after, return_inverse=True)[1].astype(np.int64)
            width *= 2
        return np.argsort(rank, kind="stable")

    def _bound(self, codes: np.ndarray, order: np.ndarray, low: np.ndarray, wanted: np.ndarray, upper: bool) -> np.ndarray:
        """For each wanted piece the first place from ``low`` on whose suffix does not lie before (after) it."""
        high = np.full(len(wanted), len(order), dtype=np.int64)
        padded = np.r_[codes, np.full(self.longest, END, dtype=codes.dtype)]
        rows = np.arange(len(wanted))
        own = self.codes[wanted]
        while (open_ := low < high).any():
            middle = (low + high) >> 1
            window = padded[order[np.minimum(middle, len(order) - 1)][:, None] + np.arange(self.longest)]
            differs = (window != own) & (own >= 0)
            first = differs.argmax(axis=1)
            unequal = differs[rows, first]
            smaller = unequal & (window[rows, first] < own[rows, first])
            go_right = open_ & (smaller | (upper & ~unequal))
            low = np.where(go_right, middle + 1, low)
            high = np.where(open_ & ~go_right, middle, high)
        return low

    def edges(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences of pieces, sorted by position: start * (longest + 1) + length, and the piece's row."""
        order = self.suffixes(codes)
        # A piece with a character that the batch has not cannot occur.
        seen = np.zeros(END + 2, dtype=bool)
        seen[codes] = True
        wanted = np.flatnonzero((seen[self.codes] | (self.codes < 0)).all(axis=1))
        low = self._bound(codes, order, np.zeros(len(wanted), dtype=np.int64), wanted, False)
        high = self._bound(codes, order, low, wanted, True)
        counts = high - low
        piece = np.repeat(wanted, counts)
        shift = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        start = order[np.repeat(low, counts) + shift]
        key = start * (self.longest + 1) + self.lengths[piece]
        sort = np.argsort(key)
        return key[sort], piece[sort]

    def _find(self, keys: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Place in the edge list of the spans, -1 where there is none."""
        wanted = start * (self.longest + 1) + length
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where((length <= self.longest) & (keys[at] == wanted), at, -1)

    def merged(self, codes: np.ndarray, keys: np.ndarray, pieces: np.ndarray) -> np.ndarray:
        """Starts of the final symbols."""
        n = len(codes)
        start, length = keys // (self.longest + 1), keys % (self.longest + 1)
        long = length > 1
        crossed = np.cumsum(np.bincount(start[long] + 1, minlength=n + 1) - np.bincount(start[long] + length[long], minlength=n + 1))
        segment = np.cumsum(crossed[:n] == 0)
        final = np.ones(n, dtype=bool)
        at, end = np.arange(n), np.arange(1, n + 1)
        lengths = np.bincount(segment)
        if (lengths > LONG).any():
            for own in np.flatnonzero(lengths > LONG):
                first, last = np.searchsorted(segment, [own, own + 1])
                self._relax(int(first), int(last), keys, pieces, final)
            short = lengths[segment] <= LONG
            at, end = at[short], end[short]
        worst = np.int64(1) << 40
        while len(at) > 1:
            after = np.r_[end[1:], n]
            same = np.r_[segment[at[1:]] == segment[at[:-1]], False]
            found = np.where(same, self._find(keys, at, after - at), -1)
            place = np.where(found >= 0, self.places[pieces[found]], worst)
            cuts = np.flatnonzero(np.r_[True, segment[at[1:]] != segment[at[:-1]]])
            best = np.minimum.reduceat(place, cuts)
            sizes = np.diff(np.r_[cuts, len(at)])
            open_ = best < worst
            is_best = np.flatnonzero((place == np.repeat(best, sizes)) & np.repeat(open_, sizes))
            owner = np.repeat(np.arange(len(cuts)), sizes)[is_best]
            chosen = is_best[np.r_[True, owner[1:] != owner[:-1]]] if len(is_best) else is_best
            final[at[chosen + 1]] = False
            end[chosen] = end[chosen + 1]
            alive = np.repeat(open_, sizes)
            alive[chosen + 1] = False
            at, end = at[alive], end[alive]
        return np.flatnonzero(final)

    def _relax(self, first: int, last: int, keys: np.ndarray, pieces: np.ndarray, final: np.ndarray) -> None:
        """As the rounds of ``merged`` for one segment, the best edge taken from a heap."""
        width = self.longest + 1
        low, high = np.searchsorted(keys, [first * width, last * width])
        place = dict(zip(keys[low:high].tolist(), self.places[pieces[low:high]].tolist()))
        n = last - first
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        gone = bytearray(n)
        heap: list[tuple[int, int, int, int]] = []

        def offer(left: int) -> None:
            right = after[left]
            if right < n and after[right] - left <= self.longest:
                found = place.get((first + left) * width + after[right] - left)
                if found is not None:
                    heappush(heap, (found, left, right, after[right]))

        for left in range(n):
            offer(left)
        while heap:
            _, left, right, end = heappop(heap)
            if gone[left] or gone[right] or after[left] != right or after[right] != end:
                continue
            gone[right] = 1
            final[first + right] = False
            after[left] = end
            if end < n:
                before[end] = left
            offer(left)
            if before[left] >= 0:
                offer(before[left])

    def learn(self, units: list[str]) -> None:
        """Encode units and remember them."""
        joined = "".join(unit + "\0" for unit in units)
        codes = np.frombuffer(joined.encode("utf-32-le"), dtype=np.int32).copy()
        sizes = np.array([len(unit) + 1 for unit in units])
        ends = np.cumsum(sizes) - 1
        codes[ends] = END
        keys, pieces = self.edges(codes)
        starts = self.merged(codes, keys, pieces)
        found = self._find(keys, starts, np.diff(np.r_[starts, len(codes)]))
        ids = np.where(found >= 0, self.ids[pieces[found]], -1)
        cuts = np.searchsorted(starts, np.r_[ends + 1 - sizes, len(codes)])
        blob = ids.astype("<i4").tobytes()
        self.known.update(zip(units, (blob[4 * first : 4 * last - 4] for first, last in zip(cuts[:-1].tolist(), cuts[1:].tolist()))))
        self.bytes += 200 * len(units) + len(joined) + len(blob)
        # A character that is no piece becomes its bytes; the mark behind a unit is none of its own.
        missing = ids < 0
        missing[cuts[1:] - 1] = False
        for row in np.unique(np.searchsorted(cuts, np.flatnonzero(missing), side="right") - 1):
            first, last = cuts[row], cuts[row + 1]
            listed: list[int] = []
            for i, at in zip(ids[first : last - 1], starts[first : last - 1]):
                listed += [int(i)] if i >= 0 else [self.byte_ids[b] for b in chr(codes[at]).encode("utf-8", "surrogatepass")]
            self.known[units[row]] = np.array(listed, dtype="<i4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids per text as little-endian 32-bit integers."""
        cut = [UNIT.findall(SPACE + text.replace(" ", SPACE)) if text else [] for text in texts]
        wanted = set().union(*cut)
        if self.bytes > REMEMBERED:
            self.known.clear()
            self.bytes = 0
        fresh, size = [], 0
        for unit in sorted(wanted - self.known.keys()):
            fresh.append(unit)
            size += len(unit) + 1
            if size >= INDEXED:
                self.learn(fresh)
                fresh, size = [], 0
        if fresh:
            self.learn(fresh)
        return [b"".join(map(self.known.__getitem__, units)) for units in cut]


def decode(model: Model, ids: np.ndarray) -> str:
    """Text of the ids; bytes that are no UTF-8 become replacement characters."""
    out = bytearray()
    first = model.kinds.index("b")
    for i in ids.tolist():
        out += bytes([i - first]) if model.kinds[i] == "b" else model.pieces[i].encode() if model.kinds[i] == "n" else b""
    return out.decode("utf-8", "replace").replace(SPACE, " ").removeprefix(" ")


_ENCODERS: dict[Model, Encoder] = {}


def encoder_of(model: Model) -> Encoder:
    """The worker's encoder for a model; the units it has met serve the worker's next tasks too."""
    if model not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[model] = Encoder(model)
    return _ENCODERS[model]


def _slices(sizes: list[int], most: int) -> Iterator[slice]:
    first = total = 0
    for at, size in enumerate(sizes):
        if total and total + size > most:
            yield slice(first, at)
            first, total = at, 0
        total += size
    yield slice(first, len(sizes))


def encoded(documents: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", characters: int = 2_000_000) -> DataFrame:
    """(doc_id, ids, decoded): ids and the text they decode to; batches are cut at ``characters`` (bytes of UTF-8)."""
    kind = documents.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(model)
        words = {}
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
            for part in _slices(sizes, characters):
                blobs = encoder.encode([t or "" for t in batch.column(1)[part].to_pylist()])
                offsets = np.cumsum([0, *(len(b) // 4 for b in blobs)]).astype(np.int32)
                values = np.frombuffer(b"".join(blobs), dtype="<i4")
                back = []
                for first, last in zip(offsets[:-1], offsets[1:]):
                    own = values[first:last]
                    back.append(_joined(model, own, words))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[part], pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)), pa.array(back, pa.string())],
                    names=["doc_id", "ids", "decoded"],
                )

    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")


def _joined(model: Model, ids: np.ndarray, table: dict) -> str:
    """As ``decode``, by a table of the pieces' bytes."""
    if not table:
        first = model.kinds.index("b")
        table.update({i: bytes([i - first]) if k == "b" else p.encode() if k == "n" else b"" for i, (p, k) in enumerate(zip(model.pieces, model.kinds))})
    return b"".join(map(table.__getitem__, ids.tolist())).decode("utf-8", "replace").replace(SPACE, " ").removeprefix(" ")
