"""Removal of every byte that a repeated string of ``length`` bytes covers, by a distributed suffix sort.

Only suffixes at anchors are sorted.  The anchor of a string of ``length`` bytes is the place of the least
hash of ``SEED`` bytes among its first ``REACH`` places; equal strings thus have their anchors at the same
distance from their begin.  An anchor stands for a stretch of consecutive strings that have it in common.
All of them share its core, the bytes that lie in each; the hull is what they cover together.

1. Blocks list the digests of cores and hulls.  A core that occurs in one hull only needs no sorting: if the
   hull occurs twice, all its strings repeat; if once, none does.  Copies end here, whatever their number.
2. Of the other hulls one block sends the suffix from the anchor on, and the bytes before it.  A block
   sorts its suffixes and front-codes them: each is the length of the prefix that it shares with the one
   before, and the rest.
3. A part merges the runs of all blocks with a loser tree whose nodes know the prefix that the loser
   shares with the winner, so that known prefixes are never compared again.  The prefixes that neighbours
   in the merged order share decide which strings are equal; the bytes before the anchors are merged and
   decided the same way, read backwards.
4. Blocks mark the bytes of all repeated strings and cut them out.

Defined results: a null text is empty; texts shorter than ``length`` bytes lose nothing; repeated rows lose
all that they share; the cut may split characters, so results are bytes; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .packed import PACKED, block_row, by_part, document_blocks, freeze, opened, packed_rows, thaw, whole_block
from .storage import written
from .text import Block, mix64, repeated

LENGTH, SEED, REACH, BLOCK_BYTES = 400, 32, 256, 3 << 19
NONE, ALL, SEND, SEND_ALL = range(4)  # what becomes of a hull
_U = np.uint64


class Anchors:
    """The anchors of a block: place, first and last string begin, and digests of core and hull."""

    def __init__(self, block: Block, length: int, reach: int):
        n = len(block.data)
        end = np.repeat(block.starts[1:] - 1, np.diff(block.starts))
        valid = np.arange(n) + length <= end
        seeds = n - SEED + 1
        if seeds < 1 or not valid.any():
            self.place = self.first = self.last = np.empty(0, np.int64)
            self.core = self.hull = np.empty(0, _U)
            return
        at = np.arange(seeds)
        key = (block.window_keys(SEED) & ~_U((1 << 30) - 1)) | at.astype(_U)
        key = np.append(key, np.full(-(-n // reach) * reach + reach - seeds, np.iinfo(_U).max, _U)).reshape(-1, reach)
        ahead = np.minimum.accumulate(key, axis=1).reshape(-1)
        behind = np.minimum.accumulate(key[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        begin = np.flatnonzero(valid)
        place = (np.minimum(behind[begin], ahead[begin + reach - 1]) & _U((1 << 30) - 1)).astype(np.int64)
        new = np.ones(len(begin), bool)
        new[1:] = (place[1:] != place[:-1]) | (begin[1:] != begin[:-1] + 1)
        i = np.flatnonzero(new)
        self.place, self.first = place[i], begin[i]
        self.last = begin[np.append(i[1:], len(begin)) - 1]
        self.core = block.span_hash(self.place, self.place + length - reach + 1)
        self.hull = mix64(block.span_hash(self.first, self.last + length) + (self.place - self.first).astype(_U))


def _pairs(anchors: Anchors) -> tuple[np.ndarray, ...]:
    """Distinct (core, hull), how often each occurs, one anchor of each, and each anchor's pair."""
    order = np.lexsort((anchors.hull, anchors.core))
    core, hull = anchors.core[order], anchors.hull[order]
    new = np.ones(len(order), bool)
    new[1:] = (core[1:] != core[:-1]) | (hull[1:] != hull[:-1])
    at = np.flatnonzero(new)
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    return core[at], hull[at], np.diff(np.append(at, len(order))), order[at], which


def _part_of(core: np.ndarray, parts: int) -> np.ndarray:
    return (mix64(core) % _U(parts)).astype(np.int64)


def _listed(batches, length: int, reach: int, parts: int, limit: int):
    for name, batch in document_blocks(batches, 1, limit):
        core, hull, counts, _, _ = _pairs(Anchors(whole_block(batch.column(1)), length, reach))
        rows = [block_row(name, batch)]
        rows += [
            (name, p, "pair", freeze(core[i], hull[i], np.minimum(counts[i], 2).astype(np.uint8)), None)
            for p, i in by_part(_part_of(core, parts), parts)
        ]
        yield packed_rows(rows)


def _judged(key, table):
    """What becomes of each block's hulls in one part: see the module's first step."""
    names = table["block"].to_pylist()
    lists = [thaw(a, 3) for a in table["a"].to_pylist()]
    core, hull, counts = (np.concatenate(x) for x in zip(*lists, strict=True))
    sizes = [len(x[0]) for x in lists]
    owner = np.repeat(np.array(names, np.int64), sizes)
    order = np.lexsort((owner, hull, core))
    core, hull, counts, owner = core[order], hull[order], counts[order], owner[order]
    new_core, new = np.ones(len(order), bool), np.ones(len(order), bool)
    new_core[1:] = core[1:] != core[:-1]
    new[1:] = new_core[1:] | (hull[1:] != hull[:-1])
    hull_of, core_of = np.cumsum(new) - 1, np.cumsum(new_core) - 1
    many = np.bincount(hull_of, counts)[hull_of] > 1
    contested = np.bincount(core_of, new)[core_of] > 1
    state = np.where(contested, np.where(many, np.where(new, SEND_ALL, ALL), SEND), np.where(many, ALL, NONE)).astype(np.uint8)
    back = np.empty(len(order), np.uint8)
    back[order] = state
    ends = np.cumsum(sizes)
    part = key[0].as_py()
    rows = [(name, part, "state", freeze(back[e - n : e]), None) for name, n, e in zip(names, sizes, ends, strict=True)]
    return pa.Table.from_batches([packed_rows(rows)])


def _states(core: np.ndarray, answers: dict[int, bytes], parts: int) -> np.ndarray:
    out = np.zeros(len(core), np.uint8)
    for p, i in by_part(_part_of(core, parts), parts):
        out[i] = thaw(answers[p], 1)[0]
    return out


def shared_prefix(a: bytes, b: bytes, known: int) -> int:
    """How many bytes two strings share, when they are known to share ``known``."""
    low, high = known, min(len(a), len(b))
    if a[low:high] == b[low:high]:
        return high
    while high - low > 1:  # a[:low] are equal, a[:high] are not
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def front_coded(suffixes: list[bytes]) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Shared prefix lengths, lengths and remaining bytes of sorted strings."""
    shared = [0] + [shared_prefix(a, b, 0) for a, b in zip(suffixes, suffixes[1:], strict=False)]
    rest = b"".join(s[n:] for s, n in zip(suffixes, shared, strict=False))
    return np.array(shared[: len(suffixes)], np.int32), np.array([len(s) for s in suffixes], np.int32), rest


def decoded(shared: np.ndarray, lengths: np.ndarray, rest: bytes) -> list[bytes]:
    out, at, last = [], 0, b""
    for n, size in zip(shared.tolist(), lengths.tolist(), strict=True):
        last = last[:n] + rest[at : at + size - n]
        at += size - n
        out.append(last)
    return out


def merged_runs(runs: list[tuple[list[bytes], list[int]]]) -> tuple[list[tuple[int, int]], list[int]]:
    """The order (run, place) of the strings of all runs, and the prefix that each shares with the one before.

    A run is its sorted strings and their shared prefixes with the ones before.  Each node of the loser
    tree keeps the run that lost there and the prefix it shares with the winner, the string put out last.
    A contender that shares more with that string than the loser does wins without a comparison; only
    for equal prefixes are the strings compared, from there on.
    """
    width = 1
    while width < len(runs):
        width *= 2
    strings = [r[0] for r in runs] + [[]] * (width - len(runs))
    prefixes = [r[1] for r in runs] + [[]] * (width - len(runs))
    at = [0] * width
    losers: list[tuple[int, int]] = [(-1, -1)] * width  # (run, shared prefix); a finished run shares -1

    def play(node: int, run: int, shared: int) -> tuple[int, int]:
        """The winner at a node between its loser and a contender; the other one stays."""
        other, known = losers[node]
        if shared > known:
            return run, shared
        if shared < known:
            losers[node] = (run, shared)
            return other, known
        if shared < 0:
            return run, shared
        a, b = strings[run][at[run]], strings[other][at[other]]
        n = shared_prefix(a, b, shared)
        if a[n:] < b[n:] or (a[n:] == b[n:] and run < other):
            losers[node] = (other, n)
            return run, shared
        losers[node] = (run, n)
        return other, known

    def build(node: int) -> tuple[int, int]:
        if node >= width:
            run = node - width
            return run, 0 if strings[run] else -1
        losers[node] = build(2 * node)
        return play(node, *build(2 * node + 1))

    run, shared = build(1)
    order, common = [], []
    while shared >= 0:
        order.append((run, at[run]))
        common.append(shared)
        at[run] += 1
        shared = prefixes[run][at[run]] if at[run] < len(strings[run]) else -1
        node = (run + width) // 2
        while node:
            run, shared = play(node, run, shared)
            node //= 2
    return order, common


def _sent(table, length: int, reach: int, parts: int):
    """A block's sorted, front-coded suffixes for every part."""
    batch, lists = opened(table)
    block = whole_block(batch.column(1))
    anchors = Anchors(block, length, reach)
    core, hull, _, sample, _ = _pairs(anchors)
    state = _states(core, lists.get("state", {}), parts)
    chosen = np.flatnonzero(state >= SEND)
    data, name = block.data.tobytes(), table["block"][0].as_py()
    rows = []
    for p, i in by_part(_part_of(core[chosen], parts), parts):
        i = chosen[i]
        place, first, last = (x[sample[i]].tolist() for x in (anchors.place, anchors.first, anchors.last))
        suffixes = [data[a:b + length] for a, b in zip(place, last, strict=True)]
        order = sorted(range(len(i)), key=suffixes.__getitem__)
        before = [data[first[k] : place[k]] for k in order]
        shared, lengths, rest = front_coded([suffixes[k] for k in order])
        rows.append((name, p, "run", freeze(
            shared, lengths, np.frombuffer(rest, np.uint8), np.array([len(x) for x in before], np.int32),
            np.frombuffer(b"".join(before), np.uint8), hull[i][order], state[i][order],
        ), None))
    return pa.Table.from_batches([packed_rows(rows)])


def _runs_behind(befores: list[list[bytes]]) -> list[tuple[list[bytes], list[int], list[int]]]:
    """The bytes before the anchors, read backwards, as sorted runs: strings, shared prefixes, and their places in the given runs."""
    out = []
    for texts in befores:
        back = [x[::-1] for x in texts]
        places = sorted(range(len(back)), key=back.__getitem__)
        ordered = [back[k] for k in places]
        out.append((ordered, front_coded(ordered)[0].tolist(), places))
    return out


def _repeated_strings(common, behind_rank, behind_common, ahead, strings, length: int) -> np.ndarray:
    """Marks the strings that occur twice, hull after hull in merged order, each hull's by their begin.

    A string that begins ``d`` bytes before the anchor is the last ``d`` bytes before it and the first
    ``length - d`` of the suffix.  Two are equal if all neighbours between them in the merged order share so
    long a prefix, and all between them in the merged order of the bytes before, read backwards, share
    ``d``.  No string is looked at again.
    """
    at = np.append(0, np.cumsum(strings))
    found = np.zeros(at[-1], bool)
    for d in range(int((ahead - strings).min()) + 1, int(ahead.max()) + 1):
        step = ahead - d
        have = np.flatnonzero((step >= 0) & (step < strings))
        if len(have) < 2:
            continue
        after = np.cumsum(common < length - d)[have]
        before = np.cumsum(behind_common < d)[behind_rank[have]]
        found[at[have] + step[have]] = repeated((after * (len(common) + 1) + before).astype(_U))
    return found


def _resolved(key, table, length: int, reach: int):
    """Merges the runs of a part, and tells each block which strings of its single hulls occur elsewhere."""
    names, runs, befores, hulls, states = table["block"].to_pylist(), [], [], [], []
    for a in table["a"].to_pylist():
        shared, lengths, rest, sizes, before, hull, state = thaw(a, 7)
        runs.append((decoded(shared, lengths, rest.tobytes()), shared.tolist()))
        ends, raw = np.cumsum(sizes).tolist(), before.tobytes()
        befores.append([raw[e - n : e] for n, e in zip(sizes.tolist(), ends, strict=True)])
        hulls.append(hull)
        states.append(state)
    order, common = merged_runs(runs)
    behind, behind_order = _runs_behind(befores), {}
    turned, turned_common = merged_runs([(texts, shared) for texts, shared, _ in behind])
    for rank, (r, k) in enumerate(turned):
        behind_order[r, behind[r][2][k]] = rank
    ahead = np.array([len(befores[r][k]) for r, k in order])
    strings = ahead + np.array([len(runs[r][0][k]) for r, k in order]) - length + 1  # begins at 0..strings - 1 from the hull's
    found = _repeated_strings(
        np.array(common), np.array([behind_order[r, k] for r, k in order]), np.array(turned_common), ahead, strings, length
    )
    at, rows = np.append(0, np.cumsum(strings)), []
    mine: dict[int, tuple[list[int], list[np.ndarray]]] = {}
    for x, (r, k) in enumerate(order):
        if states[r][k] == SEND:
            mask = np.zeros(reach, bool)
            mask[: strings[x]] = found[at[x] : at[x + 1]]
            if mask.any():
                ids, masks = mine.setdefault(names[r], ([], []))
                ids.append(int(hulls[r][k]))
                masks.append(np.packbits(mask))
    for name, (ids, masks) in mine.items():
        rows.append((name, key[0].as_py(), "mask", freeze(np.array(ids, _U), np.array(masks)), None))
    return pa.Table.from_batches([packed_rows(rows)])


def _cut(table, length: int, reach: int, parts: int):
    """The results of a block's documents."""
    batch, lists = opened(table)
    block = whole_block(batch.column(1))
    anchors = Anchors(block, length, reach)
    core, hull, _, _, which = _pairs(anchors)
    state = _states(core, lists.get("state", {}), parts)
    edge = np.zeros(len(block.data) + 1, np.int64)
    whole = np.flatnonzero(np.isin(state[which], (ALL, SEND_ALL)))
    np.add.at(edge, anchors.first[whole], 1)
    np.add.at(edge, anchors.last[whole] + length, -1)
    for raw in lists.get("mask", {}).values():
        ids, masks = thaw(raw, 2)
        by_id = np.argsort(ids)
        mine = np.flatnonzero(np.isin(hull[which], ids))
        bits = np.unpackbits(masks, axis=1)[by_id[np.searchsorted(ids[by_id], hull[which][mine])]]
        row, step = np.nonzero(bits)
        np.add.at(edge, anchors.first[mine[row]] + step, 1)
        np.add.at(edge, anchors.first[mine[row]] + step + length, -1)
    gone = np.cumsum(edge[:-1]) > 0
    data, out = block.data, {"doc_id": batch.column(0)}
    spans = gone.copy()
    spans[1:] &= ~gone[:-1]
    total = lambda mark: np.add.reduceat(mark.astype(np.int64), block.starts[:-1])
    kept = []
    for a, b in zip(block.starts[:-1].tolist(), (block.starts[1:] - 1).tolist(), strict=True):
        kept.append(data[a:b][~gone[a:b]].tobytes())
    out |= {"n_bytes": block.n_bytes, "n_removed": total(gone), "n_spans": total(spans),
            "kept_sha256": [hashlib.sha256(x).hexdigest() for x in kept], "kept": pa.array(kept, pa.binary())}
    return pa.table(out)


def without_repeats(
    docs: DataFrame, length: int = LENGTH, reach: int = REACH, block_bytes: int = BLOCK_BYTES, parts: int | None = None
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256, kept (bytes)."""
    if length - reach + 1 < SEED:
        raise ValueError("the core must hold a seed")
    spark = docs.sparkSession
    parts = parts or max(64, 3 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    lists = written(rows.mapInArrow(lambda batches: _listed(batches, length, reach, parts, block_bytes), PACKED), "suffix-lists")
    texts = lists.where("kind = 'text'")
    states = written(lists.where("kind = 'pair'").groupBy("part").applyInArrow(_judged, PACKED), "suffix-states")

    def send(key, table):
        return _sent(table, length, reach, parts)

    def resolve(key, table):
        return _resolved(key, table, length, reach)

    def cut(key, table):
        return _cut(table, length, reach, parts)

    runs = texts.union(states).groupBy("block").applyInArrow(send, PACKED)
    masks = runs.groupBy("part").applyInArrow(resolve, PACKED)
    return texts.union(states).union(masks).groupBy("block").applyInArrow(
        cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    )
