"""Context-tree weighting against sequential coding with exact block probabilities, by definition."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import context_tree as tree
from ledgerlake.llm.lm_score import scored

from corpora import ODD, WORD, frame, words

DEPTH = 3


def log_kt(zeros, ones):
    return math.lgamma(zeros + 0.5) + math.lgamma(ones + 0.5) - math.lgamma(zeros + ones + 1) - 2 * math.lgamma(0.5)


def grams_of(text: str):
    raw = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).encode() + b"\xff"
    padded = b"\xff" * DEPTH + raw
    return [(padded[i : i + DEPTH][::-1], padded[i + DEPTH]) for i in range(len(raw))]


def weighted(counts, context, decision, depth):
    """Log of the weighted probability of a node's subtree."""
    own = log_kt(*counts.get((context[:depth], decision), (0, 0)))
    if depth == DEPTH:
        return own
    below = sum(
        weighted(counts, c, decision, depth + 1)
        for c in {c[: depth + 1] for c, d in counts if d == decision and len(c) > depth and c[:depth] == context[:depth]}
    )
    return np.logaddexp(own, below) + math.log(0.5)


def brute_score(train, text):
    counts = defaultdict(lambda: [0, 0])
    for t in train:
        for context, byte in grams_of(t):
            for bit in range(8):
                decision = (1 << bit) | (byte >> (8 - bit))
                for depth in range(DEPTH + 1):
                    counts[context[:depth], decision][(byte >> (7 - bit)) & 1] += 1
    total = 0.0
    for context, byte in grams_of(text):
        for bit in range(8):
            decision, value = (1 << bit) | (byte >> (8 - bit)), (byte >> (7 - bit)) & 1
            now = weighted(counts, context, decision, 0)
            more = dict(counts)
            for depth in range(DEPTH + 1):
                pair = list(counts.get((context[:depth], decision), (0, 0)))
                pair[value] += 1
                more[context[:depth], decision] = pair
            total += weighted(more, context, decision, 0) - now
    return total / math.log(10)


def test_against_block_probabilities(spark):
    train = ["abab AB", "abba", "ba b"]
    docs = frame(spark, [(i, t) for i, t in enumerate(train)] + [(10, "abb"), (11, ""), (12, "zq")])
    got = {r["doc_id"]: r["score"] for r in scored(docs, F.col("doc_id") >= 10, depth=DEPTH, parts=3).collect()}
    for i, text in [*enumerate(train), (10, "abb"), (11, ""), (12, "zq")]:
        assert got[i] == pytest.approx(brute_score(train, text), rel=1e-5), text


def test_a_context_gives_all_bytes_one_together():
    data = np.frombuffer(b"the cat sat on the mat\xff", np.uint8)
    keys, counts = np.unique(tree.grams(data, np.array([0]), 2), return_counts=True)
    context = np.uint64(0x6874 << 8)  # after "th"
    every = np.unique(np.concatenate([keys, context + np.arange(256, dtype=np.uint64)]))
    known = np.zeros(len(every), np.int64)
    known[np.searchsorted(every, keys)] = counts
    logs = tree.log10_probabilities(every, known, 2, 2, *tree.top_mixture(*tree.top_sums(every, known, 2, 2), 2))
    mine = (every >> np.uint64(8)) == (context >> np.uint64(8))
    assert mine.sum() == 256 and (10 ** logs[mine]).sum() == pytest.approx(1.0)
    assert every[mine][np.argmax(logs[mine])] & np.uint64(255) == ord("e")


def test_base_counts_and_odd_rows(spark):
    rows = [(i, " ".join(words(i, 40))) for i in range(30)] + ODD + [(9001, None), (5, " ".join(words(5, 40)))]
    held = lambda i: i % 3 == 0
    got = scored(frame(spark, rows, extra=True), F.col("doc_id") % 3 == 0, depth=2, block_bytes=500, parts=5).collect()
    assert len(got) == len(rows)
    low = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    counts, end = Counter(), 0
    for i, t, *_ in rows:
        if not held(i):
            counts.update(WORD.findall(low(t)))
            end += 1
    total, distinct = sum(counts.values()) + end, len(counts) + 1
    texts = {r[0]: r[1] for r in rows}
    for r in got:
        tokens = WORD.findall(low(texts[r["doc_id"]]))
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in tokens) + math.log10((end + 1) / (total + distinct + 1))
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(tokens) + 1, sum(counts[w] > 0 for w in tokens) + 1, total)
        assert r["base_score"] == pytest.approx(base) and r["held_out"] == held(r["doc_id"]) and r["score"] < 0


def test_nothing_to_learn_or_to_score(spark):
    untaught = scored(frame(spark, [(1, "ab")]), F.lit(True)).first()
    assert untaught["score"] == pytest.approx(-3 * 8 * math.log10(2)) and untaught["train_tokens"] == 0
    assert scored(frame(spark, []), F.lit(False)).count() == 0


def test_blocks_and_parts_do_not_matter(spark):
    docs = frame(spark, [(i, " ".join(words(i, 60))) for i in range(40)])
    runs = [
        {r["doc_id"]: r["score"] for r in scored(docs.repartition(n), F.col("doc_id") % 4 == 0, block_bytes=b, parts=p).collect()}
        for n, b, p in ((1, 1 << 20, 2), (7, 300, 50))
    ]
    assert all(runs[0][i] == pytest.approx(runs[1][i], rel=1e-5) for i in runs[0])


def test_hot_pairs_and_groups_of_blocks_do_not_matter(spark):
    rows = [(i, " ".join(words(i, 60))) for i in range(40)] + [(50, "a" * 3000), (51, None), (52, "")]
    train = F.col("doc_id") % 4 == 0
    runs = [
        {r["doc_id"]: (r["score"], r["base_score"], r["n_known"]) for r in scored(
            frame(spark, rows), train, block_bytes=300, parts=7, hot_share=hot, group=group
        ).collect()}
        for hot, group in ((1, 1000), (10, 1000), (1000, 3), (1 << 40, 10))
    ]
    for run in runs[1:]:
        for i, (score, base, known) in runs[0].items():
            assert run[i] == (pytest.approx(score, rel=1e-5), pytest.approx(base, rel=1e-9), known), i


def test_hot_pairs_against_block_probabilities(spark):
    train = ["abab AB", "abba", "ba b"]
    docs = frame(spark, [(i, t) for i, t in enumerate(train)] + [(10, "abb"), (12, "zq")])
    got = {r["doc_id"]: r["score"] for r in scored(docs, F.col("doc_id") >= 10, depth=DEPTH, parts=3, hot_share=100, group=1).collect()}
    for i, text in [*enumerate(train), (10, "abb"), (12, "zq")]:
        assert got[i] == pytest.approx(brute_score(train, text), rel=1e-5), text
