"""Sum-of-squares online packing of tokenised documents into windows of fixed capacity.

Each task reads its documents once, in order. What fills whole windows of a document is cut off;
the rest goes to the fill level for which the sum of the squared numbers of windows at each partial
level grows least, from an array of counts by level. Nothing is shuffled and nothing goes to the driver.

At its end a task settles its open windows: those filled to a power of two need no padding and stay;
of the others the emptiest are cut to fill the fullest, and the last one is cut at the
binary digits of its fill. So cuts are few and no window is padded.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm.common import slices
from spanloom.llm.tokens import load_encoder

#: Tokens that a task holds in open windows before it settles them (4 bytes each).
HELD = 4 << 20

#: A piece: document, start in it, its ids, length of the document.
Piece = tuple[int | None, int, np.ndarray, int]


def power_of_two(n: int) -> bool:
    return n > 0 and n & (n - 1) == 0


class Windows:
    """Open windows by fill level, and the rule that picks a level for each piece."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        #: Windows at each level; level 0 stands for a new window and the capacity for a full one. These two
        #: aren't squared: their halves give the same comparison as the sums of squares do.
        self.levels = np.zeros(capacity + 1)
        self.levels[0], self.levels[capacity] = 0.5, -0.5
        self.open: dict[int, list[list[Piece]]] = {}
        self.held = 0

    def choose(self, size: int) -> int:
        """The level from which a piece of ``size`` adds least to the sum of squares; the fullest of equal ones.

        From h to h + size the sum grows by 2 * (n[h + size] - n[h]) + 2; a new window adds 2 * n[size] + 1
        and a window that gets full takes 2 * n[h] - 1 off, which the halves at both ends stand for.
        """
        n = self.levels
        gain = n[: self.capacity - size + 1] - n[size:]
        gain = np.where(n[: len(gain)] > 0, gain, -np.inf)
        return len(gain) - 1 - int(gain[::-1].argmax())

    def put(self, piece: Piece) -> list[Piece] | None:
        """Place a piece; the window's pieces if it is full now."""
        size = len(piece[2])
        level = self.choose(size)
        window = self.take(level) if level else []
        window.append(piece)
        return self.keep(window, level + size)

    def take(self, level: int) -> list[Piece]:
        self.levels[level] -= 1
        self.held -= level
        window = self.open[level].pop()
        if not self.open[level]:
            del self.open[level]
        return window

    def keep(self, window: list[Piece], level: int) -> list[Piece] | None:
        if level == self.capacity:
            return window
        self.levels[level] += 1
        self.held += level
        self.open.setdefault(level, []).append(window)
        return None

    def settle(self) -> Iterator[list[Piece]]:
        """All open windows, none of which needs padding; afterwards none is open."""
        for level in sorted(self.open):
            while power_of_two(level) and level in self.open:
                yield self.take(level)
        loose: list[Piece] = []  # pieces of the emptiest windows
        while self.open:
            level = max(self.open)
            window, room = self.take(level), self.capacity - level
            while room:
                if not loose:
                    if not self.open:
                        break
                    loose = self.take(min(self.open))
                piece = loose.pop()
                own, rest = cut(piece, room)
                window.append(own)
                room -= len(own[2])
                if rest is not None:
                    loose.append(rest)
            if room:
                yield from binary_windows(window)
            else:
                yield window
        while loose:
            window, room = [], self.capacity
            while room and loose:
                own, rest = cut(loose.pop(), room)
                window.append(own)
                room -= len(own[2])
                if rest is not None:
                    loose.append(rest)
            if room:
                yield from binary_windows(window)
            else:
                yield window


def cut(piece: Piece, size: int) -> tuple[Piece, Piece | None]:
    """The first ``size`` ids of a piece, and what is left."""
    doc, start, ids, n = piece
    if len(ids) <= size:
        return piece, None
    return (doc, start, ids[:size], n), (doc, start + size, ids[size:], n)


def binary_windows(window: list[Piece]) -> Iterator[list[Piece]]:
    """A window's pieces in windows whose fills are the binary digits of their sum."""
    left = sum(len(p[2]) for p in window)
    pieces = window[::-1]
    while left:
        room = 1 << (left.bit_length() - 1)
        left -= room
        part = []
        while room:
            own, rest = cut(pieces.pop(), room)
            part.append(own)
            room -= len(own[2])
            if rest is not None:
                pieces.append(rest)
        yield part


PLACES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack_online(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 0, held: int = HELD) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its ids and ``end_id``. Each id lies in exactly one piece and each window of at most
    ``capacity`` ids has no gap. Windows are full or hold a power of two, so none is padded. A task
    settles its windows at its end, and before that whenever they hold more than ``held`` ids.

    Null and empty texts are the end id alone; repeated rows and null ids are packed like any other;
    very long texts are encoded in parts; an empty table gives no rows; other columns are ignored.
    A sequence's number is made of the task's partition and a count, so a task run anew gives
    the same rows for the same input.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, windows = load_encoder(tokenizer), Windows(capacity)
        sequence = TaskContext.get().partitionId() << 40
        rows: list[tuple] = []

        def close(window: list[Piece]) -> None:
            nonlocal sequence
            offset = 0
            for doc, start, ids, n in window:
                rows.append((doc, start, len(ids), zlib.crc32(ids), n, sequence, offset))
                offset += len(ids)
            sequence += 1

        def flushed() -> pa.RecordBatch:
            names = [x.split()[0] for x in PLACES.split(", ")]
            out = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [()] * len(names))], names)
            rows.clear()
            return out

        for batch in batches:
            for part in slices(batch, "text"):
                ids, ends = encoder.encode(part.column("text"))
                for doc, b, e in zip(part.column("doc_id").to_pylist(), ends[:-1].tolist(), ends[1:].tolist()):
                    own = np.append(ids[b:e], np.uint32(end_id)).astype("<u4")
                    whole = len(own) // capacity * capacity
                    for start in range(0, whole, capacity):
                        close([(doc, start, own[start : start + capacity], len(own))])
                    if whole < len(own) and (full := windows.put((doc, whole, own[whole:].copy(), len(own)))):
                        close(full)
                    if windows.held > held:
                        for window in windows.settle():
                            close(window)
                yield flushed()
        for window in windows.settle():
            close(window)
        yield flushed()

    rows_in = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows_in.mapInArrow(pack, PLACES)
