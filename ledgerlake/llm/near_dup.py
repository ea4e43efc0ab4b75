"""Near-duplicate classes by ProbMinHash signatures, banding and exact verification.

A document's shingles are its runs of five words (a shorter text is one shingle); a shingle that occurs c
times weighs 1 + ln c.  Every shingle emits points of a Poisson process whose rate is its weight, each into a
random register; a register keeps its earliest arrival, and a document stops as soon as no further point
can be early enough.  Equal registers of two documents have their probability Jaccard similarity as chance:
the sum over common shingles i of 1 / sum over all j of max(x_j / x_i, y_j / y_i).  Documents with equal
registers in a whole band are candidates, and two texts are linked when that similarity, computed exactly
from the texts, is 0.8 or more.

Equal texts (equal word sequences) are one node from the start.  A bucket's members are compared with one
centre, then with up to 16, 256, ... new centres a round, those first that meet the most others over all
their buckets: an original meets each of its copies more often than they meet each other.  After the first round each bucket has a main
class, the largest there; members outside it are strays.  Every member becomes a centre for the strays, since
a stray may be near to any member of the main class, until no stray is left (other buckets can bring one
into the class too) or all have been centres.  So each candidate pair is compared or within one class.
Comparing starts with sketches of ``WIDE`` further registers, which are made of candidates alone, and of
``WIDER`` ones where a bucket has more than ``LARGE`` members: texts meet only where as many registers agree
as a similarity of 0.8 gives but for 4.5 standard deviations, a cut near 0.73 and 0.777.  Copies of one
original that are not near to each other therefore meet in no join.
Classes are the connected components of the links; each round joins the classes that its links connect.

Defined results: texts without a word (null, empty, blank) are alone in their classes; repeated rows
share one; an empty table gives no rows; other columns are ignored by ``near_classes`` and passed
through by ``one_of_each``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .components import components
from .storage import written
from .text import Block, blocks, mix64, sums

WORDS, SIMILARITY, BANDS, ROWS, CENTRES = 5, 0.8, 32, 6, 16
WIDE, WIDER, PER_LONG, LARGE, BROADCAST_NODES = 1024, 8192, 32, 64, 1_000_000
_U = np.uint64


def shingles(block: Block, k: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, hash, count) of the distinct shingles of each text, ordered by text."""
    n = block.n_words
    first, hashes = block.windows(k)
    owner = np.repeat(np.arange(len(block)), n)[first]
    short = np.flatnonzero((n > 0) & (n < k))
    owner = np.concatenate([owner, short])
    hashes = np.concatenate([hashes, block.run_hash(block.words_at[short], block.words_at[short] + n[short])])
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(new)
    return owner[at], hashes[at], np.diff(np.append(at, len(owner)))


def prob_min_hash(owner: np.ndarray, hashes: np.ndarray, weights: np.ndarray, n: int, registers: int) -> np.ndarray:
    """The shingle (upper half of its hash) that arrives first in each register of each of ``n`` texts."""
    none = np.iinfo(np.uint64).max
    first = np.full(n * registers, none, _U)
    time, step = np.zeros(len(hashes)), 0
    while len(hashes):
        step += 1
        draw = mix64(hashes + _U(step * 0x9E3779B97F4A7C15 % 2**64))
        time = time - np.log(((draw >> _U(11)).astype(float) + 0.5) * 2.0**-53) / weights
        register = (mix64(draw) % _U(registers)).astype(np.int64)
        arrival = time.astype(np.float32).view(np.uint32).astype(_U) << _U(32)
        np.minimum.at(first, owner * registers + register, arrival | (hashes >> _U(32)))
        latest = first.reshape(n, registers).max(axis=1) >> _U(32)
        going = (arrival >> _U(32)) < latest[owner]  # a shingle's points come in order
        owner, hashes, weights, time = owner[going], hashes[going], weights[going], time[going]
    return (first & _U(0xFFFFFFFF)).reshape(n, registers)


def weight_of(counts: np.ndarray) -> np.ndarray:
    return 1 + np.log(counts)


def band_keys(block: Block, bands: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of distinct shingles of each text, and its band keys (texts x bands)."""
    owner, hashes, counts = shingles(block)
    signature = prob_min_hash(owner, hashes, weight_of(counts), len(block), bands * rows)
    keys = np.zeros((len(block), bands), _U)
    for r in range(rows):
        keys = mix64(keys + signature[:, r::rows] + _U(r + 1))
    return np.bincount(owner, minlength=len(block)), mix64(keys + np.arange(bands, dtype=_U))  # a key says which band it is of


def sketches(block: Block, registers: int = WIDE, seed: int = 1) -> np.ndarray:
    """Two bits of every register of a signature of its own, ``PER_LONG`` registers to a number (texts x numbers)."""
    owner, hashes, counts = shingles(block)
    pairs = prob_min_hash(owner, mix64(hashes + _U(seed)), weight_of(counts), len(block), registers) & _U(3)
    places = _U(2) * np.arange(PER_LONG, dtype=_U)
    return (pairs.reshape(len(block), -1, PER_LONG) << places).sum(axis=2, dtype=_U)


def least_alike(similarity: float, registers: int = WIDE) -> float:
    """How many registers of two sketches agree at least at this similarity, but for 4.5 standard deviations."""
    alike = similarity + (1 - similarity) / 4  # unlike registers agree in two bits by chance
    return registers * alike - 4.5 * (registers * alike * (1 - alike)) ** 0.5


def _differing(x: Column) -> Column:
    return F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555)))


def equal_registers(a: Column, b: Column) -> Column:
    """In how many of ``WIDE`` places two sketches agree."""
    differ = F.lit(0)
    for i in range(WIDE // PER_LONG):
        differ = differ + _differing(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i))))
    return F.lit(WIDE) - differ


def may_be_near(similarity: float, a: str, b: str, wider_a: str, wider_b: str) -> Column:
    """By ``WIDE`` registers, and where both have them by ``WIDER`` others too."""
    each = F.zip_with(wider_a, wider_b, lambda x, y: _differing(x.bitwiseXOR(y)))
    differ = F.aggregate(each, F.lit(0), lambda total, n: total + n)
    wider = F.coalesce(F.lit(WIDER) - differ >= least_alike(similarity, WIDER), F.lit(True))
    return (equal_registers(F.col(a), F.col(b)) >= least_alike(similarity)) & wider


def _nodes(block: Block) -> pa.Array:
    """16 bytes that name each text's word sequence."""
    first, last = block.words_at[:-1], block.words_at[1:]
    pair = np.column_stack([block.run_hash(first, last), block.run_hash(first, last, 1)])
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(block), [None, pa.py_buffer(pair.astype(">u8").tobytes())]).cast(pa.binary())


def _lists(values: np.ndarray) -> pa.Array:
    at = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(at), pa.array(values.reshape(-1).view(np.int64)))


def _signed_nodes(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    def sign(batches):
        for batch in batches:
            for first, last, block in blocks(batch.column(2)):
                n, keys = band_keys(block, bands, rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[first:last], batch.column(1)[first:last], _nodes(block), pa.array(n), _lists(keys)],
                    ["doc_id", "code", "node", "n", "bands"],
                )

    return docs.select("doc_id", F.xxhash64("text").alias("code"), "text").mapInArrow(
        sign, "doc_id long, code long, node binary, n long, bands array<long>"
    )


def _sketched(texts: DataFrame) -> DataFrame:
    """(node, sketch, wider) of texts (node, text, large); only nodes of large buckets have the wider one."""

    def sketch(batches):
        for batch in batches:
            large = batch.column(2).to_numpy(zero_copy_only=False)
            for mark in (False, True):
                part = batch.take(pa.array(np.flatnonzero(large == mark)))
                for first, last, block in blocks(part.column(1)):
                    wider = _lists(sketches(block, WIDER, 2)) if mark else pa.nulls(len(block), pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays([part.column(0)[first:last], _lists(sketches(block)), wider], ["node", "sketch", "wider"])

    return texts.select("node", "text", "large").mapInArrow(sketch, "node binary, sketch array<long>, wider array<long>")


def probability_jaccard(a: Block, b: Block) -> np.ndarray:
    """The exact similarity of text i of ``a`` and text i of ``b``.

    With all shingles of a pair in order of y_j / x_j, the larger of x_j / x_i and y_j / y_i is the former up to i
    and the latter behind it, so that the sum over j comes from running sums.
    """
    parts = [shingles(x) for x in (a, b)]
    owner = np.concatenate([o for o, _, _ in parts])
    hashes = np.concatenate([h for _, h, _ in parts])
    weights = np.concatenate([weight_of(c) for _, _, c in parts])
    of_b = np.repeat([False, True], [len(o) for o, _, _ in parts])
    order = np.lexsort((of_b, hashes, owner))
    owner, hashes, weights, of_b = owner[order], hashes[order], weights[order], of_b[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    which = np.cumsum(new) - 1
    pair = owner[new]
    x, y = (np.bincount(which[side], weights[side], len(pair)) for side in (~of_b, of_b))
    with np.errstate(divide="ignore"):
        ratio = np.where(x > 0, y / np.where(x > 0, x, 1), np.inf)
    order = np.lexsort((ratio, pair))
    pair, x, y = pair[order], x[order], y[order]
    begins = np.searchsorted(pair, np.arange(len(a) + 1))
    run_x, run_y = (np.concatenate([[0.0], np.cumsum(v)]) for v in (x, y))
    both = np.flatnonzero((x > 0) & (y > 0))
    p = pair[both]
    upto = run_x[both + 1] - run_x[begins[p]]
    behind = run_y[begins[p + 1]] - run_y[both + 1]
    return np.bincount(p, 1 / (upto / x[both] + behind / y[both]), len(a))


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """(u, v, linked) of pairs (u, v) by their texts (node, text)."""

    def compare(batches):
        for batch in batches:
            for first, last, a in blocks(batch.column(2)):
                part = batch.slice(first, last - first)
                (_, _, b), = blocks(part.column(3), 1 << 62)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(probability_jaccard(a, b) >= similarity - 1e-9)], ["u", "v", "linked"]
                )

    left = texts.select(F.col("node").alias("u"), F.col("text").alias("a"))
    right = texts.select(F.col("node").alias("v"), F.col("text").alias("b"))
    return pairs.join(left, "u").join(right, "v").select("u", "v", "a", "b").mapInArrow(compare, "u binary, v binary, linked boolean")


def _texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, text), one text of each wanted node (node, doc_id, code)."""
    source = docs.select(F.col("doc_id").alias("d"), F.xxhash64("text").alias("c"), "text")
    same = F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("c") == F.col("code"))
    few = wanted.count() <= BROADCAST_NODES  # 32 bytes each; then the texts of all others stay where they are
    return source.join(F.broadcast(wanted) if few else wanted, same).select("node", "text").dropDuplicates(["node"])


def _joined_classes(labels: DataFrame, links: DataFrame, most: int) -> DataFrame:
    """The labels (node, label) after joining the classes that links (u, v) connect."""
    ends = [labels.select(F.col("node").alias(end), F.col("label").alias(f"label_{end}")) for end in ("u", "v")]
    between = links.join(ends[0], "u").join(ends[1], "v").select(F.col("label_u").alias("u"), F.col("label_v").alias("v"))
    moved = components(between).select(F.col("node").alias("label"), F.col("label").alias("now"))
    return written(labels.join(moved, "label", "left").select("node", F.coalesce("now", "label").alias("label")), "labels", most)


def linked_labels(docs: DataFrame, signed: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(node, label) of all nodes that share a bucket with another: equal labels for a class."""
    spoken = signed.where("n > 0")
    nodes = spoken.groupBy("node").agg(F.first("bands").alias("bands"))
    rows = nodes.select("node", F.explode("bands").alias("key"))
    # one shuffle of all rows; counting first and joining the counts takes one more as soon as they are too many to broadcast
    counted = rows.withColumn("k", F.count("*").over(Window.partitionBy("key")))
    paired = written(counted.where("k > 1").select("key", "node", "k"), "paired")
    scores = written(paired.groupBy("node").agg(F.sum("k").alias("score"), (F.max("k") > LARGE).alias("large")), "scores")
    chosen = written(
        spoken.join(paired.select("node").distinct(), "node", "left_semi").groupBy("node").agg(F.min(F.struct("doc_id", "code")).alias("one")),
        "chosen",
    )
    texts = written(_texts_of(docs, chosen.select("node", "one.doc_id", "one.code")), "texts")
    sketched = written(_sketched(texts.join(scores, "node")), "sketches")
    most_nodes = chosen.count()
    labels = chosen.select("node", F.col("node").alias("label"))
    tested, anchors, number = None, None, 0
    pool = paired.join(scores, "node").select("key", "node", "score", F.col("node").alias("label"), F.lit(False).alias("used"), F.lit(True).alias("stray"))
    while most := pool.count():
        number += 1
        hashed = F.xxhash64("node", F.lit(number))
        slot = F.pmod(hashed, F.lit(CENTRES ** (number - 1)))  # each yields a centre: 1, then CENTRES at most, ...
        centres = written(
            pool.where("not used").groupBy("key", slot.alias("slot")).agg(F.max(F.struct("score", hashed.alias("h"), "node", "label")).alias("c"))
            .select("key", F.col("c.node").alias("centre"), F.col("c.label").alias("class"))
            .join(sketched.select(F.col("node").alias("centre"), F.col("sketch").alias("other"), F.col("wider").alias("wider_other")), "centre"),
            "centres", most,
        )
        near = F.col("label") != F.col("class")  # a link within a class would tell nothing
        near &= may_be_near(similarity, "sketch", "other", "wider", "wider_other")
        strays = pool.where("stray").join(sketched, "node").withColumnRenamed("key", "k")
        found = strays.join(centres, (F.col("k") == F.col("key")) & near)
        new = found.select(F.least("node", "centre").alias("u"), F.greatest("node", "centre").alias("v")).distinct()
        if tested is not None:
            new = new.join(tested, ["u", "v"], "left_anti")
        verified = written(_verified(new, texts, similarity), "verified")
        if not verified.where("linked").isEmpty():
            labels = _joined_classes(labels, verified.where("linked"), most_nodes)
        apart = verified.where("NOT linked").select("u", "v")
        tested = apart if tested is None else tested.union(apart)
        now = centres.select("key", F.col("centre").alias("node"), F.lit(True).alias("now"))
        left = pool.select("key", "node", "score", "used").join(now, ["key", "node"], "left").join(labels, "node")
        if number == 1:  # its centre was compared with all members
            left = left.where("now is null")
        left = written(left.select("key", "node", "score", "label", (F.col("used") | F.col("now").isNotNull()).alias("used")), "left", most)
        if anchors is None:
            sizes = left.groupBy("key", "label").agg(F.count("*").alias("k"), F.min("node").alias("node"))
            largest = sizes.groupBy("key").agg(F.count("*").alias("classes"), F.max(F.struct("k", "node")).alias("most")).where("classes > 1")
            anchors = written(largest.select("key", F.col("most.node").alias("node")), "anchors", most)
        mains = anchors.join(labels, "node").select("key", F.col("label").alias("main"))
        left = left.join(mains, "key").withColumn("stray", F.col("label") != F.col("main")).drop("main").where("stray or not used")
        left = written(left, "left", most)
        going = left.groupBy("key").agg(F.max("stray").alias("some"), F.min("used").alias("done")).where("some and not done")
        pool = written(left.join(going.select("key"), "key", "left_semi"), "pool", most)
    return labels


def near_classes(docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per document: doc_id, code (hash of its text), class_id (least doc_id of its class), class_size, kept."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = written(_signed_nodes(base, bands, rows), "signatures")
    labels = linked_labels(base, signed, similarity)
    # a text without words is a class of its own; repeated rows of it share one
    alone = F.concat(F.lit(b"-"), F.encode(F.concat_ws(":", F.col("doc_id").cast("string"), F.col("code").cast("string")), "UTF-8"))
    named = written(
        signed.select("doc_id", "code", "n", "node").join(labels, "node", "left").select(
            "doc_id", "code", F.when(F.col("n") > 0, F.coalesce("label", "node")).otherwise(alone).alias("class")
        ),
        "named",
    )
    whole = written(named.groupBy("class").agg(F.min(F.struct("doc_id", "code")).alias("one"), F.count("*").alias("class_size")), "classes")
    return named.join(whole, "class").select(
        "doc_id", "code", F.col("one.doc_id").alias("class_id"), "class_size",
        (F.col("doc_id").eqNullSafe(F.col("one.doc_id")) & (F.col("code") == F.col("one.code"))).alias("kept"),
    )


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The document of least (id, text hash) of each class, with all its columns."""
    kept = near_classes(docs, **options).where("kept").select(F.col("doc_id").alias("__id"), F.col("code").alias("__code")).distinct()
    id_ = F.col("doc_id").cast("long")
    stay = docs.join(kept, id_.eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__code")))
    return stay.dropDuplicates(["__id", "__code"]).select(*docs.columns)
