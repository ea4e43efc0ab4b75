"""Language-model scores of whole texts by context-tree weighting, and by the plain word counts beside it.

Texts are split into training and scored ones by their ids; all are scored.  The work is cut twice.
A block is some megabytes of text; it lists its distinct grams (and words) with their training counts.
A part of the tree holds whole subtrees: those below two context bytes, or below three where the two
are hot, that is begin more than a 1024th of all grams.  So no common pair of bytes makes a part large, at
most 1,023 pairs are hot, and a hot subtree has at most 2^24 grams, however much text there is.

1. The lists of a part are added up by groups of ``GROUP`` blocks, then over the groups.
2. Parts weigh their subtrees and send the sums that the top of the tree needs: at most 255 for each context
   of one byte and each hot pair.
3. Parts compute the probabilities of their grams and give them to every group of blocks, which answers its
   blocks' lists in order.  Blocks then look every byte up in their answers.

The model is thus spread over all parts, whatever its size, and no task holds the lists of all blocks.
Lists travel as compressed arrays; a block's texts travel once, as one compressed row.

Defined results: a null text is empty and is scored as its end alone; without any training text every
decision has probability one half; repeated rows are scored, and learned from, one by one; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from . import context_tree as tree
from .packed import (
    PACKED, block_row, by_part, document_blocks, opened, pack, pack_sorted, packed_rows, unpack, unpack_sorted, whole_block,
)
from .storage import written
from .text import Block, mix64, sums

DEPTH, TOP, BLOCK_BYTES = 5, 2, 4 << 20
HOT = 1024  # a pair of context bytes is hot beyond this part of all grams
GROUP = 256  # blocks whose lists are added up, and answered, together
_FOLD = 1 << 22  # listed keys that are held before they are added up


def _pair(grams: np.ndarray, depth: int) -> np.ndarray:
    """The two latest context bytes of each gram, or the only one."""
    return (grams >> np.uint64(8 * (depth - 1))).astype(np.int64)


def _is_hot(grams: np.ndarray, depth: int, hot: np.ndarray) -> np.ndarray:
    flags = np.zeros(1 << 16, bool)
    flags[hot] = True
    return flags[_pair(grams, depth)]


def _gram_part(grams: np.ndarray, depth: int, hot: np.ndarray, parts: int) -> np.ndarray:
    """The part of each gram, by its two latest context bytes, by three where these are hot."""
    root = _pair(grams, depth).astype(np.uint64)
    if len(hot):
        deeper = _is_hot(grams, depth, hot)
        root[deeper] = (grams[deeper] >> np.uint64(8 * (depth - 2))) | np.uint64(1 << 32)
    return (mix64(root) % np.uint64(parts)).astype(np.int64)


def _word_part(words: np.ndarray, parts: int) -> np.ndarray:
    return (mix64(words) % np.uint64(parts)).astype(np.int64)


def _words(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word, and where each text's words begin."""
    low = block.lowered()
    return low.word_hash, low.words_at


def _grams(block: Block, depth: int) -> np.ndarray:
    """The gram of every byte; the end of a text is coded as one more byte."""
    coded = block.lowered().data
    coded[block.starts[1:] - 1] = tree.EDGE
    return tree.grams(coded, block.starts[:-1], depth)


def _pair_counts(batches, limit: int):
    """How often each pair of context bytes occurs in a task's texts."""
    total = np.zeros(1 << 16, np.int64)
    for _, batch in document_blocks(batches, 0, limit):
        total += np.bincount(_pair(_grams(whole_block(batch.column(0)), TOP), TOP), minlength=1 << 16)
    pair = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(total[pair])], ["pair", "n"])


def _lists_of(batches, depth: int, hot: np.ndarray, parts: int, limit: int):
    """The rows of all blocks of a task: their texts, grams and words."""
    for name, batch in document_blocks(batches, 1, limit):
        rows = [block_row(name, batch)]
        learn = ~pc.fill_null(batch.column(2), False).to_numpy(zero_copy_only=False)
        block = whole_block(batch.column(1))
        words, words_at = _words(block)
        rows += _counted(name, "word", words, np.repeat(learn, np.diff(words_at)), lambda x: _word_part(x, parts), parts)
        del words
        grams = _grams(block, depth)
        rows += _counted(name, "gram", grams, np.repeat(learn, np.diff(block.starts)), lambda x: _gram_part(x, depth, hot, parts), parts)
        yield packed_rows(rows)


def _counted(name: int, kind: str, keys: np.ndarray, learn: np.ndarray, part_of, parts: int) -> list[tuple]:
    """List rows of the distinct keys of a block and how often each occurs in its training texts."""
    taught = keys[learn]
    taught.sort()
    new = np.ones(len(taught), bool)
    new[1:] = taught[1:] != taught[:-1]
    at = np.flatnonzero(new)
    known = taught[at]
    every = np.union1d(known, keys[~learn])
    counts = np.zeros(len(every), np.int64)
    counts[np.searchsorted(every, known)] = np.diff(np.append(at, len(taught)))
    return [(name, p, kind, pack_sorted(every[i]), pack(counts[i])) for p, i in by_part(part_of(every), parts)]


def _added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys with their total counts."""
    every, where = np.unique(np.concatenate(keys), return_inverse=True)
    return every, np.bincount(where, np.concatenate(counts), len(every)).astype(np.int64)


def _add_lists(key, table):
    """One list of all that are given for a kind and part; few keys beyond the distinct ones are held at a time."""
    keys, counts, held, least = [], [], 0, 0
    for a, b in zip(table["a"], table["b"], strict=True):
        keys.append(unpack_sorted(a.as_py()))
        counts.append(unpack(b.as_py(), np.int64))
        held += len(keys[-1])
        if held > _FOLD + 2 * least:
            every, total = _added(keys, counts)
            keys, counts, held = [every], [total], len(every)
            least = held
    every, total = _added(keys, counts)
    rows = [(-1, key[1].as_py(), key[0].as_py(), pack_sorted(every), pack(total))]
    return pa.Table.from_batches([packed_rows(rows)])


def _answered_lists(table):
    """The answers to the lists of a group of blocks, from the one row (of block -1) that holds their part's values."""
    blocks = table["block"].to_numpy()
    home = int(np.flatnonzero(blocks < 0)[0])
    part, kind = table["part"][home].as_py(), table["kind"][home].as_py()
    keys = unpack_sorted(table["a"][home].as_py())
    values = unpack(table["b"][home].as_py(), np.float32 if kind == "gram" else np.int64)
    rows = [
        (int(blocks[i]), part, kind, pack(values[np.searchsorted(keys, unpack_sorted(table["a"][i].as_py()))]), None)
        for i in np.flatnonzero(blocks >= 0).tolist()
    ]
    return pa.Table.from_batches([packed_rows(rows)])


def _by_root(keys: np.ndarray, depth: int, hot: np.ndarray):
    """(bytes of the subtrees' roots, places) of a part's grams: two for most, three for the hot ones."""
    deeper = _is_hot(keys, depth, hot)
    return [(top, np.flatnonzero(deeper == (top > TOP))) for top in (TOP, TOP + 1) if (deeper == (top > TOP)).any()]


_TOP_COLUMNS = ("context", "decision", "below", "zeros", "ones")


def _top_of(sums: pa.Table, hot: np.ndarray) -> tuple[np.ndarray, ...]:
    """The mixtures above the parts: for contexts of one byte, and for the hot ones of two."""
    size = sums["size"].to_numpy()
    columns = [sums[c].to_numpy() for c in _TOP_COLUMNS]
    near, far = ([c[size == n] for c in columns] for n in (TOP, TOP + 1))
    weight = tree.weighted_nodes(*far[2:])
    node, where = np.unique(np.append(near[0] << 8 | near[1], (far[0] >> 8) << 8 | far[1]), return_inverse=True)
    both = [np.bincount(where, np.append(a, b), len(node)) for a, b in zip(near[2:], (weight, *far[3:]), strict=True)]
    mixed, left = tree.top_mixture(node >> 8, node & 255, *both, TOP)
    return mixed, left, *tree.deeper_mixture(mixed, left, hot, *far)


def scored(
    docs: DataFrame, held_out: Column, depth: int = DEPTH, block_bytes: int = BLOCK_BYTES, parts: int | None = None,
    hot_share: int = HOT, group: int = GROUP,
) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte.

    ``held_out`` marks the documents that are not learned from.  The score is the model's log10
    probability of the text's bytes (A-Z in lower case) and its end; the base score is that of its
    tokens, words and one end, by their add-one smoothed training frequencies.  ``hot_share`` and ``group``
    shape the work, not the result.
    """
    spark = docs.sparkSession
    parts = parts or max(64, 3 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    hot = np.empty(0, np.int64)
    if depth > TOP:
        pairs = rows.select("text").mapInArrow(lambda batches: _pair_counts(batches, block_bytes), "pair long, n long")
        pairs = written(pairs.groupBy("pair").agg(F.sum("n").alias("n")), "pairs", rows=1 << 16)
        share = F.col("n") * hot_share > F.lit(pairs.agg(F.sum("n")).first()[0] or 0)
        hot = np.array(sorted(r.pair for r in pairs.where(share).collect()), np.int64)  # fewer than hot_share
    lists = written(rows.mapInArrow(lambda batches: _lists_of(batches, depth, hot, parts, block_bytes), PACKED), "lists")
    texts, asked = lists.where("kind = 'text'"), lists.where("kind in ('gram', 'word')")
    n_train = rows.where("not held_out").count()  # every training text has one end token

    groups = max(1, -(-texts.select("block").count() // group))
    asked = asked.withColumn("share", F.pmod(F.xxhash64("block"), F.lit(groups)))
    whole = asked
    if groups > 1:
        whole = whole.groupBy("kind", "part", "share").applyInArrow(_add_lists, PACKED)
    whole = written(whole.select("block", "part", "kind", "a", "b").groupBy("kind", "part").applyInArrow(_add_lists, PACKED), "counts")

    def taught(batches):
        for batch in batches:
            counts = [unpack(b.as_py(), np.int64) for b in batch.column(0)]
            values = [[np.count_nonzero(x) for x in counts], [x.sum() for x in counts]]
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in values], ["kinds", "learned"])

    total = whole.where("kind = 'word'").select("b").mapInArrow(taught, "kinds long, learned long").agg(F.sum("kinds"), F.sum("learned")).first()
    distinct, learned = (total[0] or 0) + (n_train > 0), (total[1] or 0) + n_train

    def tops(batches):
        for batch in batches:
            for a, b in zip(batch.column(0), batch.column(1), strict=True):
                keys, counts = unpack_sorted(a.as_py()), unpack(b.as_py(), np.int64)
                for top, i in _by_root(keys, depth, hot):
                    sums = [x.astype(np.float64 if c == "below" else np.int64) for c, x in zip(_TOP_COLUMNS, tree.top_sums(keys[i], counts[i], depth, top), strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(sums[0]), top)), *map(pa.array, sums)], ["size", *_TOP_COLUMNS])

    grams = whole.where("kind = 'gram'")
    sums = (
        grams.select("a", "b").mapInArrow(tops, "size long, context long, decision long, below double, zeros long, ones long")
        .groupBy("size", "context", "decision").agg(*(F.sum(c).alias(c) for c in _TOP_COLUMNS[2:]))
    ).toArrow()  # 255 decisions for each of 256 contexts and of the hot pairs, at most
    shared = spark.sparkContext.broadcast(_top_of(sums, hot))  # 8 MB, and 32 KB for each hot pair

    def values(batches):
        mixed, left, deep_mixed, deep_left = shared.value
        for batch in batches:
            for part, a, b in zip(batch.column(1).to_pylist(), batch.column(3), batch.column(4), strict=True):
                keys, counts = unpack_sorted(a.as_py()), unpack(b.as_py(), np.int64)
                logs = np.zeros(len(keys), np.float32)
                for top, i in _by_root(keys, depth, hot):
                    above = (deep_mixed, deep_left, hot) if top > TOP else (mixed, left)
                    logs[i] = tree.log10_probabilities(keys[i], counts[i], depth, top, *above)
                yield packed_rows([(-1, part, "gram", a.as_py(), pack(logs))])

    known = grams.mapInArrow(values, PACKED).union(whole.where("kind = 'word'"))
    known = known.withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    answers = asked.union(known).groupBy("kind", "part", "share").applyInArrow(lambda key, table: _answered_lists(table), PACKED)

    def look_up(key, table):
        return _scores(table, depth, hot, parts, distinct, learned, n_train)

    return answers.union(texts).groupBy("block").applyInArrow(
        look_up, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long, bits_per_byte double"
    )


def _answered(keys: np.ndarray, part_of, answers: dict[int, bytes], parts: int, kind) -> np.ndarray:
    """The answer for every position, from the answers to the sorted distinct keys of each part."""
    distinct, where = np.unique(keys, return_inverse=True)
    value = np.zeros(len(distinct), kind)
    for p, i in by_part(part_of(distinct), parts):
        value[i] = unpack(answers[p], kind)
    return value[where]


def _scores(table: pa.Table, depth: int, hot: np.ndarray, parts: int, distinct: int, learned: int, ends: int) -> pa.Table:
    """The scores of one block from its texts and its answers."""
    batch, answers = opened(table)
    block = whole_block(batch.column(1))
    logs = _answered(_grams(block, depth), lambda x: _gram_part(x, depth, hot, parts), answers["gram"], parts, np.float32)
    score = np.add.reduceat(logs, block.starts[:-1], dtype=float)
    del logs
    words, at = _words(block)
    counts = _answered(words, lambda x: _word_part(x, parts), answers.get("word", {}), parts, np.int64)
    n_tokens = np.diff(at) + 1
    worth = np.concatenate([[0.0], np.cumsum(np.log10(counts + 1.0))])
    base = worth[at[1:]] - worth[at[:-1]] + np.log10(ends + 1.0) - n_tokens * np.log10(learned + distinct + 1.0)
    n_bytes = block.n_bytes
    return pa.table({
        "doc_id": batch.column(0), "held_out": batch.column(2), "n_tokens": n_tokens,
        "n_known": sums(counts > 0, at) + (ends > 0), "train_tokens": np.full(len(block), learned),
        "base_score": base, "score": score, "n_bytes": n_bytes, "bits_per_byte": -score / np.log10(2) / (n_bytes + 1),
    })
