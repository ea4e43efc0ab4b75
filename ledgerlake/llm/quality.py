"""Quality rules: boosted trees over document statistics, on top of fixed base rules.

Statistics come from whole texts.  The trees are fitted on a bounded sample of labelled documents,
flattened into numpy arrays and evaluated for a batch at a time, one tree level at once.  Some
statistics may only ever lower the score (``FALLING``): more symbols or repeats never help.

Defined results: a null or empty text has zero words and fails the base rules; repeated rows are
judged one by one; an empty table gives no rows; without labels of both kinds every score is the
share of good labels (1 without any), so the base rules decide alone; other columns are ignored by
``quality_verdicts`` and passed through by ``keep_good``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .text import Block, blocks, covered, later, mix64, repeated, sums

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "log_words", "mean_word", "symbol_rate", "dup_line_rate", "repeat_rate", "upper_rate", "digit_rate",
    "mark_rate", "bang_rate", "short_rate", "distinct_rate", "echo_rate", "line_words",
)
FALLING = ("symbol_rate", "dup_line_rate", "repeat_rate", "echo_rate", "bang_rate")

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in "!\"'(),-./:;?[]{}_=+~^@\\`"]] = True


def statistics(block: Block) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The base counts and the matrix of features of each text of a block."""
    data, starts, at = block.data, block.starts, block.words_at
    n_words = block.n_words
    per_text = lambda mark: sums(mark, starts)
    inside = (data & 0xC0) != 0x80  # first bytes of characters
    char_at = np.concatenate([[0], np.cumsum(inside)])
    length = char_at[block.word_to] - char_at[block.word_from]
    word_chars = sums(length, at)
    n_symbols = per_text(_SYMBOL[data])

    line_words = np.searchsorted(block.word_from, block.line_to) - np.searchsorted(block.word_from, block.line_from)
    full = np.flatnonzero(line_words > 0)
    owner = block.text_of(block.line_from[full]).astype(np.uint64)
    lines = block.span_hash(block.line_from[full], block.line_to[full])
    again = later(mix64(lines + mix64(owner + np.uint64(1))))
    n_dup_lines = np.bincount(owner[again].astype(np.int64), minlength=len(block))

    first, hashes = block.windows(5)
    owner = np.repeat(np.arange(len(block), dtype=np.uint64), n_words)
    found = repeated(mix64(hashes + mix64(owner[first] + np.uint64(1))))
    n_repeat_words = sums(covered(first[found], 5, len(block.word_from)), at)

    echo = np.zeros(len(block.word_from), bool)
    echo[1:] = (block.word_hash[1:] == block.word_hash[:-1]) & (owner[1:] == owner[:-1])
    new = ~later(mix64(block.word_hash + mix64(owner + np.uint64(1))))
    n_lines = sums(line_words > 0, block.lines_at)

    words, chars = np.maximum(n_words, 1), np.maximum(word_chars, 1)
    features = np.column_stack([
        np.log1p(n_words), word_chars / words, n_symbols / chars, n_dup_lines / np.maximum(n_lines, 1), n_repeat_words / words,
        per_text((data >= 65) & (data <= 90)) / chars, per_text((data >= 48) & (data <= 57)) / chars,
        per_text(_MARK[data]) / chars, per_text(data == 33) / chars, sums(length <= 3, at) / words,
        sums(new, at) / words, sums(echo, at) / words, n_words / np.maximum(n_lines, 1),
    ])
    counts = dict(zip(COUNTS, (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words), strict=True))
    return counts, features


def base_failed(counts: dict[str, np.ndarray]) -> np.ndarray:
    """Under 10 words, or more than 20 % of the words in repeated five-word windows."""
    return (counts["n_words"] < 10) | (100 * counts["n_repeat_words"] > 20 * counts["n_words"])


@dataclass
class Forest:
    """Complete trees of one depth as arrays: children of node i are 2i + 1 (value <= cut) and 2i + 2."""

    feature: np.ndarray  # trees x inner nodes
    cut: np.ndarray
    leaf: np.ndarray  # trees x leaves
    start: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """The log odds of each row."""
        total, rows = np.full(len(x), self.start), np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            while inner and len(x) and node[0] < inner:  # all rows are at one level
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += leaf[node - inner]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def fit_forest(
    x: np.ndarray, y: np.ndarray, falling: tuple[int, ...] = (), trees: int = 60, depth: int = 3,
    bins: int = 64, rate: float = 0.2, smooth: float = 1.0, least: float = 1.0,
) -> Forest:
    """Boosted trees for the logistic loss; the score never rises with a feature in ``falling``."""
    inner, n = 2**depth - 1, max(len(y), 1)
    share = float(np.clip(y.mean(), 0.5 / n, 1 - 0.5 / n)) if len(y) else 1 - 1e-9
    forest = Forest(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)), float(np.log(share / (1 - share))))
    if len(np.unique(y)) < 2:
        return forest
    cuts = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) for column in x.T]
    binned = np.column_stack([np.searchsorted(c, column, side="left") for c, column in zip(cuts, x.T, strict=True)])
    margin, kept = np.full(len(y), forest.start), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        slope, curve = y - p, p * (1 - p)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(y), np.int64)
        bounds = {0: (-np.inf, np.inf)}
        value = {0: 0.0}
        for at in range(inner):
            low, high = bounds[at]
            rows = np.flatnonzero(node == at)
            best = (1e-6, 0, np.inf, value[at], value[at])
            g_all, h_all = slope[rows].sum(), curve[rows].sum()
            gain_of = lambda g, h, v: g * v - 0.5 * (h + smooth) * v * v
            for f, c in enumerate(cuts):
                if not len(rows) or not len(c):
                    continue
                g = np.cumsum(np.bincount(binned[rows, f], slope[rows], len(c) + 1))[:-1]
                h = np.cumsum(np.bincount(binned[rows, f], curve[rows], len(c) + 1))[:-1]
                left = np.clip(g / (h + smooth), low, high)
                right = np.clip((g_all - g) / (h_all - h + smooth), low, high)
                whole = np.clip(g_all / (h_all + smooth), low, high)
                gain = gain_of(g, h, left) + gain_of(g_all - g, h_all - h, right) - gain_of(g_all, h_all, whole)
                gain[(h < least) | (h_all - h < least)] = -1
                if f in falling:
                    gain[left < right] = -1
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (gain[k], f, c[k], left[k], right[k])
            _, feature[at], cut[at], a, b = best
            middle = (a + b) / 2
            side = feature[at] in falling
            bounds[2 * at + 1], bounds[2 * at + 2] = ((middle, high), (low, middle)) if side else ((low, high), (low, high))
            value[2 * at + 1], value[2 * at + 2] = a, b
            node[rows] = 2 * at + 1 + (x[rows, feature[at]] > cut[at])
        leaf = rate * np.array([value[inner + i] for i in range(inner + 1)])
        kept.append((feature, cut, leaf))
        margin += leaf[node - inner]
    f, c, v = zip(*kept, strict=True)
    return Forest(np.array(f), np.array(c), np.array(v), forest.start)


def fit_quality(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000) -> Forest:
    """Trees for ``labels.quality`` (1 good, 0 bad) of at most ``max_rows`` labelled documents, chosen by hash.

    Only that bounded sample is broadcast and its features collected; scoring covers all documents.
    """
    spark = docs.sparkSession
    sample = (
        labels.select(F.col("doc_id").alias("id"), F.col("quality").cast("int").alias("good"))
        .where("good in (0, 1) and id is not null").groupBy("id").agg(F.min("good").alias("good"))
        .orderBy(F.xxhash64("id"), "id").limit(max_rows).toPandas()
    )
    schema = "id long, good int"
    chosen = spark.createDataFrame([(int(a), int(b)) for a, b in sample.itertuples(index=False)], schema)
    known = docs.select(F.col("doc_id").alias("id"), "text").join(F.broadcast(chosen), "id").select("id", "good", "text")

    def features(batches):
        for batch in batches:
            for a, b, block in blocks(batch.column(2)):
                _, x = statistics(block)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:b], batch.column(1)[a:b], pa.array(list(x), pa.list_(pa.float64()))], ["id", "good", "x"]
                )

    rows = (
        known.mapInArrow(features, "id long, good int, x array<double>")
        .orderBy(F.xxhash64("id"), "id", "x").limit(max_rows).toPandas()
    )
    x = np.array(rows["x"].tolist(), float).reshape(len(rows), len(FEATURES))
    return fit_forest(x, rows["good"].to_numpy(float), tuple(FEATURES.index(f) for f in FALLING))


def quality_verdicts(docs: DataFrame, model: Forest, threshold: float = 0.5) -> DataFrame:
    """One row per document: its counts, the base rules' verdict, the trees' score, and whether it is kept."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, score double, kept boolean"

    def judge(batches):
        for batch in batches:
            for a, b, block in blocks(batch.column(1)):
                counts, x = statistics(block)
                failed, score = base_failed(counts), model.probability(x)
                values = [*counts.values(), failed, score, ~failed & (score >= threshold)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:b], *map(pa.array, values)], ["doc_id", *COUNTS, "base_failed", "score", "kept"]
                )

    return docs.select("doc_id", "text").mapInArrow(judge, schema)


def keep_good(docs: DataFrame, model: Forest, threshold: float = 0.5) -> DataFrame:
    """The documents that pass, with all their columns, without a shuffle."""
    at = docs.columns.index("text")

    def passing(batches):
        for batch in batches:
            for a, b, block in blocks(batch.column(at)):
                counts, x = statistics(block)
                good = ~base_failed(counts) & (model.probability(x) >= threshold)
                yield batch.slice(a, b - a).filter(pa.array(good))

    return docs.mapInArrow(passing, docs.schema)
