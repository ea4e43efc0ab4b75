"""Repeated lines and repeated windows of three lines, found over all documents.

``unit_dedup`` keeps the earliest occurrence of each normalised paragraph, line or sentence (a line cut
further, so that passages set into the middle of a line are found).  ``window_dedup``
keeps the earliest occurrence of each run of three consecutive lines and removes the lines that any
later occurrence covers.

Both work in three steps.  One pass turns every text into digests.  Each digest's count and earliest
rank (document id, document digest, position) come from a partial aggregation; digests seen once are
dropped there.  What is left is joined to its occurrences in an ordinary join, whose skewed
partitions Spark splits; a digest in a third of all lines is one row on the aggregated side.

Defined results: a null text is empty and has no units; a repeated row's units are later occurrences;
an empty table gives no rows; very long texts are cut by line only, never shortened.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, functions as F

from .storage import written
from .text import Block, blocks, mix64

PARAGRAPH, LINE, SENTENCE = "paragraph", "line", "sentence"
_FULL_STOP = np.frombuffer(b".!?", np.uint8)



def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("code"), "text")


def line_units(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, end (without its line end) and text number of every line."""
    return block.line_from, block.line_to, block.text_of(block.line_from)


def unit_words(block: Block, unit: str) -> np.ndarray:
    """The first word of every unit, and at the end the number of words."""
    begin, end = block.word_from, block.word_to
    line = np.searchsorted(block.line_to, begin)
    opens = np.ones(len(begin), bool)
    if unit == PARAGRAPH:  # lines without a blank one between them belong together
        opens[1:] = (line[1:] > line[:-1] + 1) | (block.text_of(begin[1:]) != block.text_of(begin[:-1]))
    else:
        opens[1:] = line[1:] != line[:-1]
        if unit == SENTENCE:
            opens[1:] |= np.isin(block.data[end[:-1] - 1], _FULL_STOP)
    return np.append(np.flatnonzero(opens), len(begin))


def _digests(docs: DataFrame, describe) -> DataFrame:
    """Rows (doc_id, code, pos, a, b) of what ``describe(block)`` returns as (text number, position, a, b)."""

    def rows(batches):
        for batch in batches:
            for first, last, block in blocks(batch.column(2)):
                owner, pos, a, b = describe(block)
                at = pa.array(owner)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[first:last].take(at), batch.column(1)[first:last].take(at),
                     pa.array(pos.astype(np.int32)), _signed(a), _signed(b)],
                    ["doc_id", "code", "pos", "a", "b"],
                )

    return _keyed(docs).mapInArrow(rows, "doc_id long, code long, pos int, a long, b long")


def _later_positions(digests: DataFrame, purpose: str) -> DataFrame:
    """(doc_id, code, positions) of all occurrences that are not the earliest of their digest."""
    found = written(digests, purpose)
    place = F.struct("doc_id", "code", "pos")
    # rows that repeat an id with its text share one place
    shared = written(
        found.groupBy("a", "b").agg(F.min(place).alias("least"), F.max(place).alias("most"))
        .where("least != most").select("a", "b", "least"),
        purpose + "-shared",
    )
    return (
        found.join(shared, ["a", "b"]).where(place != F.col("least"))
        .groupBy("doc_id", "code").agg(F.collect_set("pos").alias("positions"))
    )


def _with_positions(docs: DataFrame, positions: DataFrame) -> DataFrame:
    """All columns of the documents, and the positions to remove as the last one."""
    gone = positions.select(F.col("doc_id").alias("__id"), F.col("code").alias("__code"), F.col("positions").alias("__positions"))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__code"))
    return docs.join(gone, same, "left").drop("__id", "__code")


def _position_mask(column: pa.Array, at: np.ndarray) -> np.ndarray:
    """Marks unit ``at[i] + p`` for each position p in the list of text i."""
    mask = np.zeros(at[-1], bool)
    flat = column.flatten()
    if len(flat):
        sizes = np.nan_to_num(np.array(pa.compute.list_value_length(column).to_numpy(zero_copy_only=False), float)).astype(int)
        mask[np.repeat(at[:-1], sizes) + flat.to_numpy(zero_copy_only=False)] = True
    return mask


def _kept_texts(block: Block, begin, end, owner, gone) -> list[bytes]:
    """Each text without the units marked ``gone``; what stays is joined by line ends."""
    data = block.data.tobytes()
    out: list[list[bytes] | bytes] = [[] for _ in range(len(block))]
    touched = np.zeros(len(block), bool)
    touched[owner[gone]] = True
    for t in np.flatnonzero(~touched):
        out[t] = data[block.starts[t] : block.starts[t + 1] - 1]
    for b, e, t in zip(*(x[touched[owner] & ~gone].tolist() for x in (begin, end, owner)), strict=True):
        out[t].append(data[b:e])
    return [x if isinstance(x, bytes) else b"\n".join(x) for x in out]


def _unit_digests(units: tuple[str, ...], min_words: int):
    """Describes the units of all levels; a unit's position is its number in the text and its level."""

    def describe(block: Block):
        parts = []
        for level, unit in enumerate(units):
            at = unit_words(block, unit)
            first, last = at[:-1], at[1:]
            owner = block.text_of(block.word_from[first])
            number = np.arange(len(first)) - np.searchsorted(first, block.words_at)[owner]
            if unit == SENTENCE and len(first):  # a short one counts together with the one before it in its line
                line = np.searchsorted(block.line_to, block.word_from[first])
                joined = np.flatnonzero((last - first < min_words) & (line == np.append(-1, line[:-1])))
                first = first.copy()
                first[joined] = at[joined - 1]
            long = np.flatnonzero(last - first >= (min_words if unit == SENTENCE else 1))
            first, last = first[long], last[long]
            parts.append((
                owner[long], number[long] * len(units) + level,
                block.run_hash(first, last, 2 * level), block.run_hash(first, last, 2 * level + 1),
            ))
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))

    return lambda block: describe(block.lowered())


def _units_gone(block: Block, units: tuple[str, ...], column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """First words of the finest units, and which of them go: by themselves or with a unit they lie in."""
    places = pa.compute.list_flatten(column).to_numpy(zero_copy_only=False)
    owner = pa.compute.list_parent_indices(column).to_numpy(zero_copy_only=False)
    finest = unit_words(block, units[-1])[:-1]
    gone = np.zeros(len(finest), bool)
    for level, unit in enumerate(units):
        first = unit_words(block, unit)[:-1]
        own = places % len(units) == level
        mask = np.zeros(len(first), bool)
        mask[np.searchsorted(first, block.words_at)[owner[own]] + places[own] // len(units)] = True
        gone |= mask[np.searchsorted(first, finest, side="right") - 1]
    return finest, gone


def unit_dedup(docs: DataFrame, units: tuple[str, ...] = (LINE, SENTENCE), min_words: int = 5) -> DataFrame:
    """doc_id, n_units, n_removed, removed (byte spans of the original text), kept_text of every document.

    ``units`` go from coarse to fine; the finest are counted and removed, also where a coarser one that
    holds them repeats.  A unit is normalised to its words in lower case (A-Z).  The occurrence of least
    (doc_id, text hash, position) stays; later ones go, with the white space behind them.  Lines and
    paragraphs of any length are compared; a sentence of fewer than ``min_words`` words inside a line is
    compared together with the one before it.
    """

    def cut(batches):
        for batch in batches:
            for first, last, block in blocks(batch.column(1)):
                units_at, gone = _units_gone(block, units, batch.column(2)[first:last])
                begin = block.word_from[units_at]
                owner = block.text_of(begin)
                end = block.starts[owner + 1] - 1
                end[:-1] = np.minimum(end[:-1], begin[1:])
                n_gone = np.bincount(owner[gone], minlength=len(block))
                base = block.starts[owner[gone]]
                spans = pa.StructArray.from_arrays([pa.array(begin[gone] - base), pa.array(end[gone] - base)], ["start", "end"])
                step = np.zeros(len(block.data) + 1, np.int8)
                np.add.at(step, begin[gone], 1)
                np.add.at(step, end[gone], -1)
                stays = np.cumsum(step[:-1], dtype=np.int8) == 0
                stays[block.starts[1:] - 1] = False  # the added line ends
                ends = np.concatenate([[0], np.cumsum(stays)])[block.starts]
                texts = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(block), [None, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(block.data[stays].tobytes())]
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[first:last], pa.array(np.bincount(owner, minlength=len(block))), pa.array(n_gone),
                     pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n_gone)]).astype(np.int32)), spans),
                     texts.cast(pa.binary()).cast(pa.string())],
                    ["doc_id", "n_units", "n_removed", "removed", "kept_text"],
                )

    positions = _later_positions(_digests(docs, _unit_digests(units, min_words)), "units")
    marked = _with_positions(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), positions)
    return marked.select("doc_id", "text", "__positions").mapInArrow(
        cut, "doc_id long, n_units long, n_removed long, removed array<struct<start:long,end:long>>, kept_text string"
    )


def _window_digests(block: Block):
    """Windows of three consecutive lines that hold words; blank lines between them do not count."""
    begin, end, owner = line_units(block)
    a, b = np.searchsorted(block.word_from, begin), np.searchsorted(block.word_from, end)
    pos = np.arange(len(begin)) - block.lines_at[owner]
    full = np.flatnonzero(b > a)
    a, b, owner, pos = a[full], b[full], owner[full], pos[full]
    n = max(len(full) - 2, 0)
    whole = np.flatnonzero(owner[:n] == owner[2:]) if n else np.empty(0, np.int64)
    digests = []
    for seed in (0, 1):
        line = block.run_hash(a, b, seed)
        digests.append(mix64(mix64(mix64(line[whole]) + line[whole + 1]) + line[whole + 2]))
    return owner[whole], pos[whole], *digests


def _window_mask(block: Block, column: pa.Array) -> np.ndarray:
    """The lines that windows beginning at the given positions cover, with blank lines between covered ones."""
    starts = _position_mask(column, block.lines_at)
    begin, end, _ = line_units(block)
    full = np.flatnonzero(np.searchsorted(block.word_from, end) > np.searchsorted(block.word_from, begin))
    hit = np.flatnonzero(starts[full])
    step = np.zeros(len(begin) + 1, np.int64)
    np.add.at(step, full[hit], 1)
    np.add.at(step, full[hit + 2] + 1, -1)
    return np.cumsum(step[:-1]) > 0


def window_positions(docs: DataFrame) -> DataFrame:
    """(doc_id, code, positions): the first lines of all windows that occurred before."""
    return _later_positions(_digests(docs, _window_digests), "windows")


def window_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed, kept_text of every document.

    Lines are compared by their words.  Of equal windows the one of least (doc_id, text hash, line)
    stays; every line that another one covers goes, also where it overlaps the one that stays.
    """

    def cut(batches):
        for batch in batches:
            for first, last, block in blocks(batch.column(1)):
                gone = _window_mask(block, batch.column(2)[first:last])
                units = line_units(block)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[first:last], pa.array(np.diff(block.lines_at)),
                     pa.array(np.bincount(units[2][gone], minlength=len(block))),
                     pa.array(_kept_texts(block, *units, gone), pa.binary()).cast(pa.string())],
                    ["doc_id", "n_lines", "n_removed", "kept_text"],
                )

    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return _with_positions(base, window_positions(docs)).select("doc_id", "text", "__positions").mapInArrow(
        cut, "doc_id long, n_lines long, n_removed long, kept_text string"
    )


def without_repeated_windows(docs: DataFrame) -> DataFrame:
    """The documents with all their columns and the shortened text; those of which no word is left go."""
    at, names = docs.columns.index("text"), docs.columns

    def cut(batches):
        for batch in batches:
            for first, last, block in blocks(batch.column(at)):
                gone = _window_mask(block, batch.column(len(names))[first:last])
                units = line_units(block)
                left = ~gone & (np.searchsorted(block.word_from, units[1]) > np.searchsorted(block.word_from, units[0]))
                stays = np.bincount(units[2][left], minlength=len(block)) > 0
                stays |= np.bincount(units[2][gone], minlength=len(block)) == 0
                columns = [c[first:last] for c in batch.columns[:-1]]
                columns[at] = pa.array(_kept_texts(block, *units, gone), pa.binary()).cast(batch.schema.field(at).type)
                yield pa.RecordBatch.from_arrays(columns, names).filter(pa.array(stays))

    return _with_positions(docs, window_positions(docs)).mapInArrow(cut, docs.schema)
