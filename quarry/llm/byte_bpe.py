"""Byte-level BPE by monoid tree reduction.

A piece is encoded by halves, recursively; neighbours are joined by encoding
anew a window of tokens around the seam, which grows until the tokens
outside it provably stay: a token sequence is the BPE encoding of its bytes
exactly if every two adjacent tokens, encoded together, give themselves
back. So a join is right as soon as the pairs at the window's two ends pass
that test (and the window is right by itself). Joining is associative, with
the empty sequence as its unit; so is decoding, which concatenates the bytes
of the tokens.

Pieces are the matches of the tokenizer's pattern; no token crosses one.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from sys import getsizeof

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import only, small_batches

LEAF = 24  # bytes merged directly
NEVER = 1 << 62
CACHE_BYTES = 96 << 20  # of a memo of a worker, twice
LONGEST = 48  # characters of a remembered piece or chunk
ENTRY = 128  # bytes of a dictionary's own per entry, and what malloc rounds up
# White space beside a space: there a match may hold more than one of them.
_odd = regex.compile(r"\s | \s")


class Recent(dict):
    """A memo of ``make``, bounded by bytes: when what it holds reaches
    ``size`` it becomes the older half, and what is used again is carried
    over. Keys of more than LONGEST characters are made anew each time: they
    hardly come again, and are most of the bytes of unspaced scripts."""

    def __init__(self, make, size: int = CACHE_BYTES):
        super().__init__()
        self.make, self.size, self.held, self.older = make, size, 0, {}

    def __missing__(self, key):
        if len(key) > LONGEST:  # pieces, chunks, or pairs of tokens
            return self.make(key)
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        cost = ENTRY + getsizeof(key) + getsizeof(value)
        if self.held + cost > self.size:
            self.older, self.held = dict(self), 0
            self.clear()
        self.held += cost
        self[key] = value
        return value


class ByteBPE:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.stays = Recent(self._stays)
        self.pieces = Recent(self._piece)
        self.chunks = Recent(self._chunk)

    @classmethod
    def load(cls, path: str, pattern: str) -> "ByteBPE":
        """From a rank file: base64 of the token and its rank per line."""
        with open(path, "rb") as f:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}, pattern)

    def merge(self, data: bytes) -> list[int]:
        """The merges in rank order, the leftmost of equal ones first."""
        ranks = self.ranks
        if len(data) > 4 * LEAF:
            return self._merge_long(data)
        parts = [data[i : i + 1] for i in range(len(data))]
        costs = [ranks.get(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        while costs:
            best = min(costs)
            if best == NEVER:
                break
            at = costs.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del costs[at]
            if at < len(costs):
                costs[at] = ranks.get(parts[at] + parts[at + 1], NEVER)
            if at:
                costs[at - 1] = ranks.get(parts[at - 1] + parts[at], NEVER)
        return [ranks[p] for p in parts]

    def _merge_long(self, data: bytes) -> list[int]:
        """The same with a heap, for a window that had to grow far."""
        ranks, n = self.ranks, len(data)
        end, before = list(range(1, n + 1)), list(range(-1, n))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(data[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            middle = end[i]
            if middle < 0 or middle >= n or end[middle] != stop:  # one of the two is gone or has grown
                continue
            end[i], end[middle] = stop, -1
            if stop < n:
                before[stop] = i
            for start in (before[i], i):
                if start >= 0 and end[start] < n:
                    stop = end[end[start]]
                    if (r := ranks.get(data[start:stop])) is not None:
                        heapq.heappush(heap, (r, start, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[data[i : end[i]]])
            i = end[i]
        return out

    def _stays(self, pair: tuple[int, int]) -> bool:
        return self.merge(self.bytes_of[pair[0]] + self.bytes_of[pair[1]]) == list(pair)

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the bytes of both. Each end of the window grows
        (twice as far each time) until its outer neighbour stays."""
        if not left or not right or self.stays[left[-1], right[0]]:
            return left + right
        a = b = 1
        while True:
            window = self.merge(b"".join([self.bytes_of[i] for i in left[-a:] + right[:b]]))
            ok_left = a >= len(left) or self.stays[left[-a - 1], window[0]]
            ok_right = b >= len(right) or self.stays[window[-1], right[b]]
            if ok_left and ok_right:
                return left[:-a] + window + right[b:]
            a, b = a if ok_left else min(2 * a, len(left)), b if ok_right else min(2 * b, len(right))

    def reduce(self, data: bytes) -> list[int]:
        """The encoding of some bytes, by halves."""
        if len(data) <= LEAF:
            return self.merge(data)
        half = len(data) // 2
        return self.join(self.reduce(data[:half]), self.reduce(data[half:]))

    def _piece(self, piece: str) -> bytes:
        data = piece.encode()
        whole = self.ranks.get(data)
        return array("i", [whole] if whole is not None else self.reduce(data)).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        found = self.pattern.findall(chunk)
        if len(found) == 1:  # remembered as a chunk, so not as a piece too
            return self.pieces.get(found[0]) or self._piece(found[0])
        return b"".join(map(self.pieces.__getitem__, found))

    def encode(self, text: str | None) -> np.ndarray:
        """The ids of a whole text. A space between two other characters
        begins a new match, so the text is cut there, and each cut chunk is
        looked up or encoded once; other texts are matched as a whole."""
        if not text:
            return np.zeros(0, np.int32)
        if _odd.search(text) or "\x00" in text:
            got = b"".join(map(self.pieces.__getitem__, self.pattern.findall(text)))
        else:
            got = b"".join(map(self.chunks.__getitem__, text.replace(" ", "\x00 ").split("\x00")))
        return np.frombuffer(got, np.int32)

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


_loaded: dict[tuple[str, str], ByteBPE] = {}


def tokenizer(path: str, pattern: str) -> ByteBPE:
    """One per Python worker, loaded on first use from the worker's own
    copy of the vocabulary."""
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = ByteBPE.load(path, pattern)
    return _loaded[path, pattern]


def _lists(encoded: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0] + [len(x) for x in encoded]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*encoded, np.zeros(0, np.int32)])))


def round_trip(spark: SparkSession, docs: DataFrame, path: str, pattern: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, ids array<int>, decoded binary) per row of ``docs``: the ids
    of the whole text and the bytes these ids stand for.

    A null text is empty: no ids, no bytes. Special tokens have no meaning
    in a text. Ids of rows may be null or repeat; other columns are ignored;
    an empty table gives no rows.
    """
    small_batches(spark)

    def run(batches):
        bpe = tokenizer(path, pattern)
        for b in batches:
            ids = [bpe.encode(t) for t in b.column(1).to_pylist()]
            decoded = [bpe.decode(i.tolist()) for i in ids]
            yield pa.RecordBatch.from_arrays([b.column(0), _lists(ids), pa.array(decoded, pa.binary())], ["doc_id", "ids", "decoded"])

    own = only(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    return own.mapInArrow(run, "doc_id long, ids array<int>, decoded binary")


def decode(spark: SparkSession, rows: DataFrame, path: str, pattern: str, ids: str = "ids", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, decoded binary) per row; null ids decode to no bytes. An id
    that the vocabulary lacks raises."""
    small_batches(spark)

    def run(batches):
        bpe = tokenizer(path, pattern)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([bpe.decode(i or ()) for i in b.column(1).to_pylist()], pa.binary())], ["doc_id", "decoded"])

    return only(rows, doc_id=doc_id, ids=ids).mapInArrow(run, f"doc_id {dict(rows.dtypes)[doc_id]}, decoded binary")
