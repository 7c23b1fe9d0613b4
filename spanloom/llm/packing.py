"""Best-fit packing of tokenised documents by bin completion with branch and bound.

Only lengths matter for a plan, and there are at most ``capacity`` of them, so the plan is
searched on the driver over a histogram of at most ``capacity`` counts: fillings are
found once and used as often as the counts allow. Spark encodes, cuts and counts the
documents, numbers the pieces of each length and gives every piece its place.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field
from operator import itemgetter, neg

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanloom.llm.common import slices, stored
from spanloom.llm.tokens import load_encoder

Filling = tuple[tuple[int, int], ...]  # (length, how often), longest first


@dataclass
class Plan:
    """Fillings with the number of sequences that use each."""

    fillings: list[tuple[Filling, int]] = field(default_factory=list)

    @property
    def sequences(self) -> int:
        return sum(n for _, n in self.fillings)


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> Plan:
    """Longest first, each into the fullest sequence that takes it; equal sequences move together."""
    open_: dict[int, list[list]] = {}  # room left: groups of (filling, sequences)
    rooms: list[int] = []

    def put(room: int, filling: dict[int, int], n: int) -> None:
        if room not in open_:
            open_[room] = []
            rooms.insert(int(np.searchsorted(rooms, room)), room)
        open_[room].append([filling, n])

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            i = int(np.searchsorted(rooms, length))
            if i == len(rooms):
                each = min(capacity // length, left)
                n = left // each
                put(capacity - each * length, {length: each}, n)
                left -= n * each
                continue
            room = rooms[i]
            filling, n = open_[room].pop()
            if not open_[room]:
                del open_[room], rooms[i]
            used = min(n, left)
            if used < n:
                put(room, filling, n - used)
            put(room - length, {**filling, length: filling.get(length, 0) + 1}, used)
            left -= used
    groups = [(tuple(f.items()), n) for room in sorted(open_) for f, n in open_[room]]
    return Plan(groups)


def _covers(a: Filling, b: Filling) -> bool:
    """Whether the pieces of ``b`` fit into the room of the pieces of ``a``, piece by piece."""
    rooms = [x for x, n in a for _ in range(n)]
    for x in (x for x, n in b for _ in range(n)):
        fitting = [i for i, room in enumerate(rooms) if room >= x]
        if not fitting:
            return False
        rooms[min(fitting, key=rooms.__getitem__)] -= x
    return True


def undominated(counts: list[int], lengths: list[int], room: int, most: int = 4, nodes: int = 400) -> list[Filling]:
    """Fillings of ``room``, least waste first, none of which another one covers.

    ``lengths`` are the available ones in falling order. The search goes depth first from the
    longest and from as many copies as fit down to one, drops branches that can't waste less
    than the worst filling kept (all pieces from there on leave too much room), keeps the best
    ``most`` fillings, and ends at an exact filling or after ``nodes`` nodes.
    """
    found: list[tuple[int, Filling]] = []
    left_nodes = nodes
    last = lengths[-1] if lengths else room + 1
    tails = [0]  # what the shortest lengths sum to, as far as that is below the room
    for length in reversed(lengths):
        if tails[-1] >= room:
            break
        tails.append(tails[-1] + counts[length] * length)

    def descend(i: int, left: int, chosen: Filling) -> bool:
        nonlocal left_nodes
        left_nodes -= 1
        if left >= last:
            i = bisect_left(lengths, -left, lo=i, key=neg)
        if left < last or i == len(lengths):
            if len(found) < most or left < found[-1][0]:
                if not any(w <= left and _covers(f, chosen) for w, f in found):
                    found.append((left, chosen))
                    found.sort(key=itemgetter(0))
                    del found[most:]
            return left == 0
        for j in range(i, len(lengths)):
            if len(found) == most and left - tails[min(len(lengths) - j, len(tails) - 1)] >= found[-1][0]:
                return False
            length = lengths[j]
            for n in range(min(counts[length], left // length), 0, -1):
                if descend(j + 1, left - n * length, (*chosen, (length, n))) or left_nodes <= 0:
                    return True
        return False

    descend(0, room, ())
    return [f for _, f in found] or [()]


def bin_completion(counts: dict[int, int], capacity: int, branches: int = 24, steps: int | None = None) -> Plan:
    """As few sequences as the search finds; the best-fit plan is the first incumbent.

    Each step completes a sequence around the longest remaining piece with an undominated
    filling and repeats it while the counts last. A line ends when its waste exceeds what
    a plan with one sequence less than the incumbent could waste; then the latest untried
    alternatives follow. ``branches`` bounds the alternatives and ``steps`` the sequences
    completed in all lines (by default 10,000, and 8 for each length where that is more), so the
    search ends for any counts; it stops at the lower bound.
    """
    if steps is None:
        steps = max(10_000, 8 * len(counts))
    incumbent = best_fit_decreasing(counts, capacity)
    total = sum(x * n for x, n in counts.items())
    bound = -(-total // capacity)
    start = [0] * (capacity + 1)
    for length, n in counts.items():
        start[length] = n
    lines = [(start, sorted(counts, reverse=True), 0, [])]
    while lines and steps > 0 and incumbent.sequences > bound:
        have, lengths, waste, plan = lines.pop()
        have, lengths, plan = list(have), list(lengths), list(plan)
        while lengths and steps > 0:
            steps -= 1
            top = lengths[0]
            have[top] -= 1
            choices = undominated(have, lengths if have[top] else lengths[1:], capacity - top)
            have[top] += 1
            allowed = (incumbent.sequences - 1) * capacity - total
            for other in reversed(choices[1:]):
                if branches <= 0:
                    break
                rest, more, spent = _use(have, top, other, capacity, once=True)
                if waste + spent <= allowed:
                    branches -= 1
                    lines.append((rest, [x for x in lengths if rest[x]], waste + spent, [*plan, more]))
            have, more, spent = _use(have, top, choices[0], capacity)
            plan.append(more)
            waste += spent
            if waste > allowed:
                break
            for x, _ in more[0]:
                if not have[x]:
                    del lengths[bisect_left(lengths, -x, key=neg)]
        if not lengths:
            incumbent = min(incumbent, Plan(plan), key=lambda p: p.sequences)
    return incumbent


def _use(counts: list[int], top: int, rest: Filling, capacity: int, once: bool = False):
    need = dict(rest)
    need[top] = need.get(top, 0) + 1
    times = 1 if once else min(counts[x] // n for x, n in need.items())
    left = list(counts) if once else counts
    for x, n in need.items():
        left[x] -= times * n
    filling = tuple(sorted(need.items(), reverse=True))
    return left, (filling, times), times * (capacity - sum(x * n for x, n in filling))


def placements(plan: Plan) -> dict[int, np.ndarray]:
    """For each length the rows (first rank, first sequence, offset, pieces a sequence)."""
    out: dict[int, list[tuple[int, int, int, int]]] = {}
    rank: dict[int, int] = {}
    first = 0
    for filling, times in plan.fillings:
        offset = 0
        for length, n in filling:
            at = rank.get(length, 0)
            out.setdefault(length, []).append((at, first, offset, n))
            rank[length] = at + times * n
            offset += length * n
        first += times
    return {x: np.array(rows, np.int64) for x, rows in out.items()}


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int) -> DataFrame:
    """Encode documents, end each with ``end_id`` and cut longer ones at ``capacity``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load_encoder(tokenizer)
        for batch in batches:
            for part in slices(batch, "text"):
                ids, ends = encoder.encode(part.column("text"))
                rows = []
                for doc, b, e in zip(part.column("doc_id").to_pylist(), ends[:-1].tolist(), ends[1:].tolist()):
                    own = np.append(ids[b:e], np.uint32(end_id)).astype("<u4")
                    for k, start in enumerate(range(0, len(own), capacity)):
                        piece = own[start : start + capacity]
                        rows.append((doc, k, start, len(piece), zlib.crc32(piece.tobytes())))
                columns = list(zip(*rows))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds)], [x.split()[0] for x in PIECES.split(", ")]
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(cut, PIECES)


def pack_documents(
    spark: SparkSession, docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is the end id alone; repeated rows and null ids are packed like
    any other; an empty table gives no rows; other columns are ignored. Documents are
    encoded once; the driver sees only the histogram of at most ``capacity`` lengths.
    """
    pieces = stored(spark, cut_pieces(docs, tokenizer, capacity, end_id), "pieces")
    histogram = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    counts = {int(r["length"]): int(r["n"]) for r in histogram}
    where = placements(bin_completion(counts, capacity))

    # The pieces of one length are numbered in hashed parts, so a common length is no hot group.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = max(64, -(-sum(counts.values()) // (4 * tasks)))
    parts = spark.createDataFrame([(x, -(-n // share)) for x, n in counts.items()], "length long, _parts int")
    dealt = pieces.join(F.broadcast(parts), "length").withColumn(
        "_part", F.pmod(F.xxhash64("doc_id", "piece"), F.col("_parts")).cast("int")
    )
    sums = dealt.groupBy("length", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy("length").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select("length", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = W.partitionBy("length", "_part").orderBy("doc_id", "piece", "ids_crc32")
    ranked = dealt.withColumn("_rank", F.row_number().over(within)).join(sums, ["length", "_part"])
    ranked = ranked.select(*[x.split()[0] for x in PIECES.split(", ")], (F.col("_before") + F.col("_rank") - 1).alias("rank"))

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sequence, offset = np.zeros(len(frame), np.int64), np.zeros(len(frame), np.int64)
            rank = frame.pop("rank").to_numpy(np.int64)
            for length, at in frame.groupby("length").indices.items():
                rows = where[int(length)]
                row = rows[np.searchsorted(rows[:, 0], rank[at], "right") - 1]
                local = rank[at] - row[:, 0]
                sequence[at] = row[:, 1] + local // row[:, 3]
                offset[at] = row[:, 2] + local % row[:, 3] * int(length)
            yield frame.assign(sequence_id=sequence, offset=offset)

    return ranked.mapInPandas(place, f"{PIECES}, sequence_id long, offset long")
