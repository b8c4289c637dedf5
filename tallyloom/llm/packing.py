"""Packing of documents into training sequences: dominance reduction, then best fit.

Lengths are whole numbers up to the sequence length, so that the counts of pieces per length are all that the
packing must know: a table of fixed size, whatever the corpus. Martello and Toth's criterion works on it: a set
of pieces that is at least as good as every other set with the same largest piece is fixed for good, as often as
its lengths allow. What is left is packed by best fit, longest first, again by counts. Pieces then find their
place by their rank among those of their length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tallyloom.llm.bpe import word_encoder
from tallyloom.llm.common import saved, text_slices
from tallyloom.llm.token_files import END_ID

_PIECE = "doc_id long, piece int, start long, length int, ids_crc32 long, part int, local long"


def cut_into_pieces(docs: DataFrame, tokenizer: str, capacity: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per piece: place in its document, length, checksum, and rank in its input part by length."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, encode, end = TaskContext.get().partitionId(), word_encoder(tokenizer), np.array([END_ID], "<u4").tobytes()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in text_slices(batches, "text"):
            out = []
            for doc_id, ids in zip(batch["id"].to_pylist(), encode(batch["text"])):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at : at + 4 * capacity]
                    n = len(own) // 4
                    out.append((doc_id, piece, at // 4, n, zlib.crc32(own), part, int(seen[n])))
                    seen[n] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64()))],
                ["doc_id", "piece", "start", "length", "ids_crc32", "part", "local"],
            )

    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(cut, _PIECE)


class _Lengths:
    """Counts per length, with the lengths that are left in order."""

    def __init__(self, counts: dict[int, int]):
        self.n = {s: c for s, c in counts.items() if c > 0}
        self.order = sorted(self.n)

    def take(self, length: int, times: int) -> None:
        self.n[length] -= times
        if not self.n[length]:
            del self.n[length]
            self.order.pop(bisect_left(self.order, length))

    def largest(self, limit: int) -> int:
        """Largest length left up to ``limit``; 0 if there is none."""
        i = bisect_left(self.order, limit + 1)
        return self.order[i - 1] if i else 0

    def smallest(self, k: int, without: int) -> int:
        """Sum of the ``k`` smallest pieces beside one of length ``without``; very large if there are fewer."""
        total, need = 0, k
        for s in self.order:
            use = min(need, self.n[s] - (s == without))
            total, need = total + use * s, need - use
            if not need:
                return total
        return 1 << 60

    def best_pair(self, limit: int, without: int) -> int:
        """Largest sum up to ``limit`` of two pieces beside one of length ``without``; 0 if there is none."""
        best, high = 0, len(self.order) - 1
        for low, a in enumerate(self.order):
            while high >= low and a + self.order[high] > limit:
                high -= 1
            if high < low:
                break
            for i in range(high, max(low, high - 2) - 1, -1):  # the count of a length may be used up by ``without``
                b = self.order[i]
                if self.n[a] - (a == without) >= 1 and self.n[b] - (b == without) - (a == b) >= 1:
                    best = max(best, a + b)
                    break
        return best


def reduce_by_dominance(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, list[tuple[int, int]]]], dict[int, int]]:
    """Fixed patterns (times, [(length, pieces)]) and the counts that are left.

    For the largest piece j of any set: a partner k with j + k = capacity dominates every other set of j; j alone
    does if nothing fits beside it; j with the largest fitting k does if no two pieces fit beside j, or if no
    three do and no two weigh more than k.
    """
    left, fixed = _Lengths(counts), []

    def fix(times: int, *lengths: int) -> None:
        for s in lengths:
            left.take(s, times)
        merged: dict[int, int] = {}
        for s in lengths:
            merged[s] = merged.get(s, 0) + 1
        fixed.append((times, list(merged.items())))

    for j in sorted(left.n, reverse=True):  # sets that fill a sequence exactly
        if j == capacity:
            fix(left.n[j], j)
        elif 2 * j == capacity and left.n.get(j, 0) >= 2:
            times = left.n[j] // 2
            left.take(j, times)
            left.take(j, times)
            fixed.append((times, [(j, 2)]))
        elif 2 * j > capacity and j in left.n and capacity - j in left.n:
            fix(min(left.n[j], left.n[capacity - j]), j, capacity - j)
    for j in sorted(left.n, reverse=True):
        while left.n.get(j, 0):
            room = capacity - j
            k = left.largest(room)
            if k == j and left.n[j] == 1:
                k = left.largest(j - 1)
            if left.smallest(1, j) > room:
                fix(left.n[j], j)
            elif left.smallest(2, j) > room or (left.smallest(3, j) > room and left.best_pair(room, j) <= k):
                if k == j:
                    # pairs of one length are safe one by one
                    left.take(j, 1)
                    left.take(j, 1)
                    fixed.append((1, [(j, 2)]))
                else:
                    # while both lengths last, nothing that the criterion looks at gets smaller
                    fix(min(left.n[j], left.n[k]), j, k)
            else:
                break
    return fixed, left.n


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Best fit, longest first, for all pieces of a length together: patterns (times, [(length, pieces)])."""
    open_: dict[int, list[tuple[int, tuple]]] = {}
    rooms: list[int] = []
    done = []

    def put(room: int, times: int, pattern: tuple) -> None:
        if room == 0:
            done.append((times, list(pattern)))
            return
        if room not in open_:
            open_[room] = []
            insort(rooms, room)
        open_[room].append((times, pattern))

    for s in sorted(counts, reverse=True):
        n = counts[s]
        while n:
            i = bisect_left(rooms, s)
            if i < len(rooms):
                room = rooms[i]
                times, pattern = open_[room].pop()
                if not open_[room]:
                    del open_[room]
                    rooms.pop(i)
            else:
                room, times, pattern = capacity, n, ()
            each = room // s
            full = min(times, n // each)
            if full:
                put(room - each * s, full, (*pattern, (s, each)))
                n -= full * each
            if full < times:
                rest = times - full
                if n and full == n // each and n < each:
                    put(room - n * s, 1, (*pattern, (s, n)))
                    n, rest = 0, rest - 1
                if rest and pattern:
                    put(room, rest, pattern)
    done += [(times, list(pattern)) for bins in open_.values() for times, pattern in bins]
    return done


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    fixed, left = reduce_by_dominance(counts, capacity)
    return fixed + best_fit(left, capacity)


def places(patterns: list[tuple[int, list[tuple[int, int]]]]) -> dict[int, np.ndarray]:
    """Per length, rows (first rank, pieces per sequence, first sequence, first offset), in order of rank."""
    out: dict[int, list] = {}
    used: dict[int, int] = {}
    sequence = 0
    for times, pattern in patterns:
        at = 0
        for length, pieces in pattern:
            out.setdefault(length, []).append((used.get(length, 0), pieces, sequence, at))
            used[length] = used.get(length, 0) + times * pieces
            at += length * pieces
        sequence += times
    return {length: np.array(rows, np.int64) for length, rows in out.items()}


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 4096, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Pack whole documents into sequences of at most ``capacity`` tokens, as few as this method can.

    A document is its ids and the end id; only longer ones are cut, at multiples of ``capacity``. A null text counts
    as empty (the end id alone), repeated rows are packed each for itself, a null id stays null, and no rows
    give no sequences. Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset.
    """
    pieces = saved(cut_into_pieces(docs, tokenizer, capacity, id_column, text_column), "pieces")
    per_part = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    # at most ``capacity`` rows
    counts = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    where = pieces.sparkSession.sparkContext.broadcast(places(plan(counts, capacity)))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = per_part.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = where.value
        for batch in batches:
            length, rank = batch["length"].to_numpy(), batch["rank"].to_numpy()
            sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            for own in np.split(order, np.flatnonzero(np.diff(length[order])) + 1) if len(order) else []:
                n = int(length[own[0]])
                rows = table[n]
                row = rows[np.searchsorted(rows[:, 0], rank[own], "right") - 1]
                k = rank[own] - row[:, 0]
                sequence[own], offset[own] = row[:, 2] + k // row[:, 1], row[:, 3] + k % row[:, 1] * n
            kept = [batch[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    ranked = pieces.join(before, ["part", "length"]).select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", (F.col("before") + F.col("local")).alias("rank"))
    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
