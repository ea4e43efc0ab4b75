"""Blocks of documents and lists of numbers as compressed rows: few rows, few bytes to shuffle.

A block row carries some megabytes of documents; list rows carry what a block asks of, or gets from, one
part of the key space.  All have the columns of ``PACKED``.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext

from .text import Block, blocks

PACKED = "block long, part int, kind string, a binary, b binary"
_NAMES = ["block", "part", "kind", "a", "b"]
_KINDS = [pa.int64(), pa.int32(), pa.string(), pa.binary(), pa.binary()]


def pack(values: np.ndarray) -> bytes:
    """Numbers as compressed bytes, byte planes one after another, so that equal high bytes shrink to nothing."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(raw: bytes, kind) -> np.ndarray:
    kind = np.dtype(kind)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(kind.itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=np.uint64(0)))


def unpack_sorted(raw: bytes) -> np.ndarray:
    return np.cumsum(unpack(raw, np.uint64), dtype=np.uint64)


def freeze(*arrays: np.ndarray) -> bytes:
    """Several arrays as one compressed value."""
    out = io.BytesIO()
    for array in arrays:
        np.save(out, array, allow_pickle=False)
    return zstandard.ZstdCompressor(level=1).compress(out.getvalue())


def thaw(raw: bytes, n: int) -> list[np.ndarray]:
    source = io.BytesIO(zstandard.ZstdDecompressor().decompress(raw))
    return [np.load(source, allow_pickle=False) for _ in range(n)]


def packed_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, _KINDS, strict=True)], _NAMES)


def by_part(part: np.ndarray, parts: int):
    """(part, places) for each part that occurs; places keep their order."""
    order = np.argsort(part, kind="stable")
    at = np.searchsorted(part[order], np.arange(parts + 1))
    for p in np.flatnonzero(np.diff(at)):
        yield int(p), order[at[p] : at[p + 1]]


def document_blocks(batches, text_at: int, limit: int):
    """(name, batch) for batches cut and joined into blocks of at most ``limit`` bytes of text, or one longer text."""
    held, size, number = [], 0, 0
    join = lambda: pa.Table.from_batches(held).combine_chunks().to_batches()[0]
    task = TaskContext.get().partitionId() << 32
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text_at)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths.astype(np.int64) + 1)
        first = 0
        while first < len(ends):
            before = ends[first - 1] if first else 0
            last = int(np.searchsorted(ends, before + limit - size, side="right"))
            if last == first and held:
                yield task | number, join()
                held, size, number = [], 0, number + 1
                continue
            last = max(last, first + 1)
            held.append(batch.slice(first, last - first))
            size += int(ends[last - 1] - before)
            first = last
    if held:
        yield task | number, join()


def block_row(name: int, batch: pa.RecordBatch) -> tuple:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return name, -1, "text", zstandard.ZstdCompressor(level=1).compress(sink.getvalue().to_pybytes()), None


def opened(table: pa.Table) -> tuple[pa.RecordBatch | None, dict[str, dict[int, bytes]]]:
    """A block's documents, and its list rows by kind and part."""
    batch, lists = None, {}
    for part, kind, a in zip(*(table[c].to_pylist() for c in ("part", "kind", "a")), strict=True):
        if kind == "text":
            raw = zstandard.ZstdDecompressor().decompress(a)
            batch = pa.ipc.open_stream(raw).read_all().combine_chunks().to_batches()[0]
        else:
            lists.setdefault(kind, {})[part] = a
    return batch, lists


def whole_block(column: pa.Array) -> Block:
    (_, _, block), = blocks(column, 1 << 62)
    return block
