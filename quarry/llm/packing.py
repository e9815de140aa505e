"""Packing documents into sequences by the sum-of-squares rule.

Documents come one by one. Full windows are cut off a long one; what is left
goes into the fill level that minimises the sum of squares of N(h), the
number of partially filled windows at level h. The counts are a level array,
so the choice is one vectorised look over the levels, whatever the number
of open windows.

Each task packs its own documents in their order: no shuffle, and a re-run
task gives the same sequences. At its end (and whenever more than OPEN
windows are open, which bounds a task's memory) the windows still open are filled
up from the emptiest ones by cutting their documents; the one window that
remains is cut into powers of two, which need no padding.
"""

from __future__ import annotations

from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import only, small_batches
from .word_tokens import word_tokens

WINDOW = 2048
END = 1  # the id after each document
OPEN = 4096  # windows a task keeps open; beyond, all are filled up by cutting
PIECE = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class SumOfSquares:
    """Open windows by fill level; a window is a list of pieces."""

    def __init__(self, size: int):
        self.size, self.total = size, 0
        self.counts = np.zeros(size + 1, np.int64)  # N(h), zero at 0 and size
        self.open: list[deque] = [deque() for _ in range(size + 1)]

    def place(self, piece, length: int):
        """Put a piece of 1 to size ids into a window; the window if that
        filled it. Moving a window from h to h + length changes the sum of
        squares by 2 (N(h + length) - N(h)) + 2; a new one by 2 N(length) + 1;
        a window that becomes full just leaves the sum."""
        if length == self.size:
            return [piece]
        n, last = self.counts, self.size - length
        change = 2 * (n[length : self.size + 1] - n[: last + 1]) + 2
        change[0] -= 1  # a new window: N(0) is always zero
        change[last] -= 1
        held = n[: last + 1] > 0
        held[0] = True
        level = int(np.where(held, change, np.iinfo(np.int64).max).argmin())
        window = [] if level == 0 else self.open[level].popleft()
        if level:
            n[level] -= 1
            self.total -= 1
        window.append(piece)
        if level + length == self.size:
            return window
        n[level + length] += 1
        self.total += 1
        self.open[level + length].append(window)
        return None

    def rest(self):
        """The windows still open, fullest first, with their levels."""
        for level in range(self.size - 1, 0, -1):
            for window in self.open[level]:
                yield level, window


def _cut(piece, length: int):
    """Piece: (document, first id, end); the document's ids come with it."""
    doc, start, end = piece
    return (doc, start, start + length), (doc, start + length, end)


def close(windows, size: int):
    """Sequences from open windows (fullest first): each is filled up from
    the emptiest, and what remains alone is cut into powers of two."""
    left = deque(window for _, window in windows)
    while left:
        window = left.popleft()
        room = size - sum(e - s for _, s, e in window)
        while room and left:
            piece = left[-1].pop()
            doc, start, end = piece
            if end - start > room:
                piece, back = _cut(piece, room)
                left[-1].append(back)
            if not left[-1]:
                left.pop()
            window.append(piece)
            room -= piece[2] - piece[1]
        if not room:
            yield window
            continue
        total, pieces = size - room, deque(window)
        while total:  # now the last window
            want = 1 << total.bit_length() - 1
            total -= want
            out = []
            while want:
                piece = pieces.popleft()
                if piece[2] - piece[1] > want:
                    piece, back = _cut(piece, want)
                    pieces.appendleft(back)
                out.append(piece)
                want -= piece[2] - piece[1]
            yield out


def pack(
    spark: SparkSession, docs: DataFrame, vocabulary: str, size: int = WINDOW, end: int = END, text: str = "text", doc_id: str = "doc_id", open_windows: int = OPEN
) -> DataFrame:
    """One row per piece: doc_id, start (ids of its document before it),
    length, ids (unsigned 32-bit, little-endian), doc_tokens (with the end
    id), sequence_id and offset in it. A sequence is to be padded to
    ``size`` ids unless its length is a power of two.

    A null or empty text is the end id alone. Rows are packed one by one, so
    null and repeated ids stay apart by their pieces only. Other columns are
    ignored; an empty table gives no rows. A task holds the ids in at most
    ``open_windows`` windows and one batch of texts; beyond, all that are open
    are closed by cutting and the rule starts anew.
    """
    small_batches(spark)
    names = [c.split()[0] for c in PIECE.split(", ")]
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())

    def run(batches):
        from pyspark import TaskContext

        tokens, packer = word_tokens(vocabulary), SumOfSquares(size)
        sequence = TaskContext.get().partitionId() << 33
        rows: list[tuple] = []

        def emit(window):
            nonlocal sequence
            offset = 0
            for (name, total, first, ids), start, stop in window:
                rows.append((name, start, stop - start, ids[start - first : stop - first].tobytes(), total, sequence, offset))
                offset += stop - start
            sequence += 1

        def finish():
            nonlocal packer
            for window in close(packer.rest(), size):
                emit(window)
            packer = SumOfSquares(size)

        def batch():
            got = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
            rows.clear()
            return got

        for b in batches:
            for name, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = np.append(tokens.ids(t), np.uint32(end)).astype("<u4")
                n = len(ids)
                whole = n - n % size
                for start in range(0, whole, size):
                    emit([((name, n, 0, ids), start, start + size)])
                if n > whole:  # only the rest is held on to
                    full = packer.place(((name, n, whole, ids[whole:].copy()), whole, n), n - whole)
                    if full:
                        emit(full)
                    elif packer.total > open_windows:
                        finish()
                if len(rows) >= 256:
                    yield batch()
        finish()
        if rows:
            yield batch()

    return only(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(run, PIECE)
