"""Packing token sequences: dominance reduction, then best fit of what remains.

How many pieces there are of each length, at most ``capacity`` numbers, is all that a packing depends
on.  The plan made from them on the driver is a list of segments: pieces of one length, by rank, go
``per`` to a sequence, from a first sequence and an offset on.  Spark numbers the pieces of each length
and every task looks its pieces up in the plan.

Reduction (Martello and Toth): a set of up to three lengths that contains a given length and
dominates every other feasible set containing it is part of some best packing and is fixed.

Defined results: a null or empty text is the end id alone; repeated rows are packed one by one; an
empty table gives no rows; only texts longer than a sequence are cut; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .storage import bucket_count, written
from .text import blocks
from .tokens import word_ids

CAPACITY = 4096
SEGMENT = ("length", "rank_from", "rank_to", "sequence", "per", "offset")


class Plan:
    """Segments, and the counts of the lengths that are not placed yet."""

    def __init__(self, counts: np.ndarray, capacity: int):
        self.left, self.capacity = counts.astype(np.int64).copy(), capacity
        self.rank = np.zeros(capacity + 1, np.int64)
        self.segments: list[tuple[int, ...]] = []
        self.sequences = 0

    def place(self, length: int, n: int, sequence: int, per: int, offset: int) -> None:
        """The next ``n`` pieces of a length, ``per`` to a sequence."""
        self.segments.append((length, int(self.rank[length]), int(self.rank[length]) + n, sequence, per, offset))
        self.rank[length] += n
        self.left[length] -= n

    def fix(self, *lengths: int) -> None:
        """As many sequences of exactly these lengths as there are pieces for."""
        kinds, need = np.unique(lengths, return_counts=True)
        times = int((self.left[kinds] // need).min())
        offset = 0
        for length, per in zip(kinds.tolist(), need.tolist(), strict=True):
            self.place(length, times * per, self.sequences, per, offset)
            offset += per * length
        self.sequences += times


def _best_pair(lengths: np.ndarray, left: np.ndarray, room: int) -> tuple[int, int, int]:
    """The two lengths of the largest sum within ``room`` (larger first), and the largest smaller one of any such pair."""
    best, low, high, widest = (0, 0), 0, len(lengths) - 1, 0
    while low <= high:
        a, b = int(lengths[high]), int(lengths[low])
        if a + b > room or (low == high and left[a] < 2):
            high -= 1
            continue
        if a + b > sum(best):
            best = (a, b)
        widest = max(widest, b)
        low += 1
    return *best, widest


def dominating(plan: Plan, w: int) -> tuple[int, ...] | None:
    """A set with length ``w`` that dominates all others with it, or None if that is not shown."""
    left, room = plan.left, plan.capacity - w
    left[w] -= 1  # the piece itself
    try:
        fitting = np.flatnonzero(left[: room + 1])
        if not len(fitting):
            return (w,)
        p = int(fitting[-1])
        if p == room:
            return (w, p)
        small = np.repeat(fitting[:3], np.minimum(left[fitting[:3]], 3))[:3]
        if len(small) < 2 or small[0] + small[1] > room:
            return (w, p)
        if len(small) == 3 and small.sum() <= room:
            return None
        a, b, widest = _best_pair(fitting, left, room)
        if p >= a + b:
            return (w, p)
        return (w, a, b) if a == p and widest <= b else None
    finally:
        left[w] += 1


def reduce(plan: Plan) -> None:
    """Fixes dominating sets, longest pieces first, until none is found."""
    found = True
    while found:
        found = False
        for w in range(plan.capacity, 0, -1):
            while plan.left[w] and (chosen := dominating(plan, w)):
                plan.fix(*chosen)
                found = True


def best_fit(plan: Plan) -> None:
    """Places the rest, longest first, each piece where it leaves the least room."""
    room: dict[int, list[tuple[int, int]]] = {}  # by what is free: (first sequence, number of sequences)
    add = lambda free, first, n: n and room.setdefault(free, []).append((first, n))
    for w in range(plan.capacity, 0, -1):
        for free in sorted(r for r in room if r >= w) if plan.left[w] else []:
            per, still = free // w, []
            for first, n in room.pop(free):
                todo = min(int(plan.left[w]), n * per)
                if not todo:
                    still.append((first, n))
                    continue
                plan.place(w, todo, first, per, plan.capacity - free)
                full, rest = divmod(todo, per)
                add(free - per * w, first, full)
                add(free - rest * w, first + full, 1 if rest else 0)
                if n > full + (rest > 0):
                    still.append((first + full + (rest > 0), n - full - (rest > 0)))
            if still:
                room[free] = room.get(free, []) + still
            if not plan.left[w]:
                break
        if n := int(plan.left[w]):
            per = plan.capacity // w
            full, rest = divmod(n, per)
            plan.place(w, n, plan.sequences, per, 0)
            add(plan.capacity - per * w, plan.sequences, full)
            add(plan.capacity - rest * w, plan.sequences + full, 1 if rest else 0)
            plan.sequences += full + (rest > 0)


def plan_packing(counts: np.ndarray, capacity: int = CAPACITY) -> Plan:
    """``counts[n]`` is the number of pieces of length n."""
    plan = Plan(counts, capacity)
    reduce(plan)
    best_fit(plan)
    return plan


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, code, piece, start, length and checksum of the ids of each piece of each document."""

    def cut(batches):
        table = word_ids(tokenizer)
        for batch in batches:
            for first, _, block in blocks(batch.column(2)):
                ids, at = table.encode(block)
                pieces = -(-np.diff(at) // capacity)
                owner = np.repeat(np.arange(len(block)), pieces)
                number = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                begin = at[owner] + number * capacity
                end = np.minimum(begin + capacity, at[owner + 1])
                raw = memoryview(ids.astype("<u4").tobytes())
                sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
                rows = pa.array(owner + first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(number.astype(np.int32)),
                     pa.array(begin - at[owner]), pa.array(end - begin), pa.array(sums, pa.int64())],
                    ["doc_id", "code", "piece", "start", "length", "ids_crc32"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("code"), "text").mapInArrow(
        cut, "doc_id long, code long, piece int, start long, length long, ids_crc32 long"
    )


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every document."""
    spark = docs.sparkSession
    pieces = written(token_pieces(docs, tokenizer, capacity), "pieces")
    n = bucket_count(pieces.count())
    pieces = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "code", "piece", F.lit(5)), F.lit(n)))
    counted = written(pieces.groupBy("length", "bucket").agg(F.count("*").alias("n")), "length-counts", capacity * n)
    histogram = np.zeros(capacity + 1, np.int64)
    for length, total in counted.groupBy("length").agg(F.sum("n")).collect():  # at most ``capacity`` rows
        histogram[length] = total
    plan = plan_packing(histogram, capacity)
    segments = np.array(sorted(plan.segments), np.int64).reshape(-1, len(SEGMENT))
    shared = spark.sparkContext.broadcast(np.ascontiguousarray(segments.T))  # its size depends on ``capacity`` only

    ahead = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = counted.select("length", "bucket", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base"))
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "code", "piece")
    ranked = pieces.withColumn("rank", F.row_number().over(inside)).join(base, ["length", "bucket"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("rank") - 1).alias("rank")
    )

    def look_up(batches):
        length, rank_from, _, sequence, per, offset = shared.value
        keys = (length << 50) + rank_from
        for batch in batches:
            size, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            at = np.searchsorted(keys, (size << 50) + rank, side="right") - 1
            i = rank - rank_from[at]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence[at] + i // per[at]), pa.array(offset[at] + i % per[at] * size)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return ranked.mapInArrow(
        look_up, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
