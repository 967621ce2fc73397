"""Best-fit packing of documents into training sequences by linear grouping.

There are at most ``capacity`` different piece lengths, whatever the input, so
the plan is made on the driver from one count per length: large lengths are
grouped, the few sizes are combined into configurations, real lengths take the
places, small ones fill the gaps by best fit.  The plan consists of runs
("pieces number a..b in order of length go to sequences s, s+1, ...") whose
number depends on the lengths alone.  Spark numbers the pieces and looks each
up in the plan."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plexus.llm import common
from plexus.llm.encode import encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long"


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece of every document.  ``(task, length, nth)`` numbers the
    pieces of one length within one task; null text is empty (the end id alone)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task = encoder(tokenizer, end_id, 250_000).encode, TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in common.slices(batches, "text", 4 << 20, 20000):
            flat, counts = encode(batch.column("text"))
            flat = flat.astype("<u4")
            n = -(-counts // capacity)
            doc = np.repeat(np.arange(len(counts)), n)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
            start = piece * capacity
            length = np.minimum(capacity, counts[doc] - start)
            at = (np.cumsum(counts) - counts)[doc] + start
            sums = np.fromiter((zlib.crc32(flat[a:a + m]) for a, m in zip(at, length, strict=True)), np.int64, len(at))
            order = np.argsort(length, kind="stable")  # number the pieces of each length
            ranked = length[order]
            first = np.searchsorted(ranked, ranked)
            nth = np.empty(len(order), np.int64)
            nth[order] = np.arange(len(order)) - first + seen[ranked]
            np.add.at(seen, length, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()).take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length),
                 pa.array(sums), pa.array(np.full(len(doc), task, np.int32)), pa.array(nth)],
                names=[x.split()[0] for x in PIECES.split(", ")])

    return common.id_and_text(docs, id_col, text_col).mapInArrow(cut, PIECES)


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, groups: int = 256,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every piece of every document with its place: ``sequence_id``, ``offset``.

    Rows with one id are packed as documents of their own; an empty table gives
    no rows.  The pieces are written once (encoding is the dear step) and read
    for the counts and for the places."""
    pieces = common.stored(cut_pieces(docs, tokenizer, capacity, end_id, id_col, text_col), "pieces")
    per_task = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = plan(counts, capacity, groups)
    longer = np.zeros(capacity + 2, np.int64)  # pieces longer than each length
    for n, k in counts.items():
        longer[:n] += k
    first = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    numbered = pieces.join(per_task.withColumn("first", F.coalesce(first, F.lit(0))).drop("n"), ["length", "task"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length = b.column("length").to_numpy()
            number = longer[length] + b.column("first").to_numpy() + b.column("nth").to_numpy()
            run = np.searchsorted(runs[0], number, side="right") - 1
            sequence = runs[1][run] + number - runs[0][run]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in OUT[:5]), pa.array(sequence), pa.array(runs[2][run])], names=OUT)

    columns = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return numbered.mapInArrow(place, columns)


OUT = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


class _Sequences:
    """Equal sequences: ``n`` with ids from ``first`` on, filled up to ``used``."""

    __slots__ = ("first", "n", "used")

    def __init__(self, first: int, n: int, used: int):
        self.first, self.n, self.used = first, n, used


def plan(counts: dict[int, int], capacity: int = 2048, groups: int = 256, small: int | None = None):
    """Runs (number of the first piece, its sequence, offset) as three arrays.

    Pieces are numbered from the longest to the shortest.  ``small`` lengths
    (up to capacity / 8) are left for the gaps; the others form ``groups``
    groups of equally many pieces, each rounded up to its longest."""
    small = capacity // 8 if small is None else small
    runs: list[tuple[int, int, int]] = []
    kinds: list[_Sequences] = []
    lengths = sorted(counts, reverse=True)
    starts, at = {}, 0
    for n in lengths:
        starts[n], at = at, at + counts[n]
    next_id = counts.get(capacity, 0)
    if next_id:
        runs.append((0, 0, 0))  # whole sequences
    large = [n for n in lengths if small < n < capacity]
    begin, end = next_id, next_id + sum(counts[n] for n in large)
    bounds = sorted({begin + (end - begin) * g // groups for g in range(groups + 1)})
    upto = np.array([starts[n] + counts[n] for n in large], np.int64)
    length_at = lambda k: large[int(np.searchsorted(upto, k, side="right"))]
    size = [length_at(b) for b in bounds[:-1]]
    cursor, left = bounds[:-1], [b - a for a, b in zip(bounds, bounds[1:], strict=False)]
    while any(left):
        lead = next(g for g, n in enumerate(left) if n)
        take = _configuration(size, left, lead, capacity)
        times = min(left[g] // k for g, k in take.items())
        slots = [g for g, k in take.items() for _ in range(k)]
        slots = [(cursor[g] + times * j, g) for j, g in _numbered(slots)]
        # Real lengths take the places: cut where any place's length changes.
        cuts = {0, times}
        for k, _ in slots:
            i = int(np.searchsorted(upto, k, side="right"))
            while i < len(upto) and upto[i] < k + times:
                cuts.add(int(upto[i]) - k)
                i += 1
        cuts = sorted(cuts)
        for a, b in zip(cuts, cuts[1:], strict=False):
            used = 0
            for k, _ in slots:
                runs.append((k + a, next_id + a, used))
                used += length_at(k + a)
            kinds.append(_Sequences(next_id + a, b - a, used))
        for g, k in take.items():
            cursor[g] += times * k
            left[g] -= times * k
        next_id += times
    next_id = _fill(kinds, [(n, counts[n], starts[n]) for n in lengths if n <= small], runs, next_id, capacity)
    runs.sort()
    return tuple(np.array(x, np.int64) for x in (zip(*runs, strict=True) if runs else ((), (), ())))


def _numbered(slots):
    seen: dict[int, int] = {}
    for g in slots:
        yield seen.setdefault(g, 0), g
        seen[g] += 1


def _configuration(size: list[int], left: list[int], lead: int, capacity: int) -> dict[int, int]:
    """The fullest sequence with one piece of group ``lead`` (the largest left):
    a bounded knapsack over the groups, larger ones first."""
    room = capacity - size[lead]
    reached = np.full(room + 1, -2, np.int64)  # the group that first reached a sum
    reached[0] = -1
    for g in range(lead, len(size)):
        most = min(left[g] - (g == lead), room // size[g])
        for _ in range(most):
            new = np.flatnonzero((reached[size[g]:] == -2) & (reached[:room + 1 - size[g]] != -2)) + size[g]
            if not len(new):
                break
            reached[new] = g
        if reached[room] != -2:
            break
    take, total = {lead: 1}, int(np.flatnonzero(reached != -2)[-1])
    while total:
        g = int(reached[total])
        take[g] = take.get(g, 0) + 1
        total -= size[g]
    return take


def _fill(kinds: list[_Sequences], smalls, runs, next_id: int, capacity: int) -> int:
    """Best fit, longest first: a length goes where the least room is left that
    still takes it; sequences are opened when none does."""
    by_room: dict[int, list[_Sequences]] = {}
    rooms: list[int] = []  # heap of rooms that may have sequences

    def put(k: _Sequences) -> None:
        room = capacity - k.used
        if room:
            if not by_room.setdefault(room, []):
                heappush(rooms, room)
            by_room[room].append(k)

    for k in kinds:
        put(k)
    for n, count, number in smalls:
        tight = []  # rooms too small for this length: and so, perhaps, not for the next
        while count:
            while rooms and (rooms[0] < n or not by_room[rooms[0]]):
                room = heappop(rooms)
                if by_room[room]:
                    tight.append(room)
            if rooms:
                kind = by_room[rooms[0]].pop()
            else:
                kind = _Sequences(next_id, -(-count // (capacity // n)), 0)
                next_id += kind.n
            if kind.n > count:
                put(_Sequences(kind.first + count, kind.n - count, kind.used))
                kind.n = count
            runs.append((number, kind.first, kind.used))
            number, count = number + kind.n, count - kind.n
            kind.used += n
            put(kind)
        for room in tight:
            heappush(rooms, room)
    return next_id
