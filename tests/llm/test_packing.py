import itertools
import random
import zlib

import numpy as np
import pytest

from ledgerlake.llm import packing
from ledgerlake.llm.queries import pack_tokenizer

from corpora import ODD, frame, words

tokenizers = pytest.importorskip("tokenizers")


def laid_out(plan):
    """Sequences as lists of (offset, length), from the plan's segments."""
    out = {}
    for length, first, last, sequence, per, offset in plan.segments:
        for rank in range(last - first):
            out.setdefault(sequence + rank // per, []).append((offset + rank % per * length, length))
    return {s: sorted(x) for s, x in out.items()}


def check(plan, counts):
    placed = laid_out(plan)
    assert set(placed) == set(range(plan.sequences))
    for pieces in placed.values():
        at = 0
        for offset, length in pieces:
            assert offset == at
            at += length
        assert at <= plan.capacity
    found = np.bincount([n for x in placed.values() for _, n in x], minlength=len(counts))
    assert (found == counts).all()
    for n in np.flatnonzero(counts):  # ranks of a length are numbered without gaps
        spans = sorted((s[1], s[2]) for s in plan.segments if s[0] == n)
        assert spans[0][0] == 0 and spans[-1][1] == counts[n] and all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))


def fewest(items, capacity):
    """The least number of sequences, by trying everything."""
    items = sorted(items, reverse=True)
    best = [len(items)]

    def put(k, bins):
        if len(bins) >= best[0]:
            return
        if k == len(items):
            best[0] = len(bins)
            return
        for i in range(len(bins)):
            if bins[i] >= items[k] and bins[i] not in bins[:i]:
                put(k + 1, [*bins[:i], bins[i] - items[k], *bins[i + 1 :]])
        put(k + 1, [*bins, capacity - items[k]])

    put(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(60))
def test_reduction_loses_nothing(seed):
    draw = random.Random(seed)
    capacity = draw.choice([10, 20, 37])
    items = [draw.randint(1, capacity) for _ in range(draw.randint(1, 9))]
    counts = np.bincount(items, minlength=capacity + 1)
    plan = packing.Plan(counts, capacity)
    packing.reduce(plan)
    rest = list(itertools.chain.from_iterable([n] * int(k) for n, k in enumerate(plan.left)))
    assert plan.sequences + fewest(rest, capacity) == fewest(items, capacity)
    packing.best_fit(plan)
    check(plan, counts)


@pytest.mark.parametrize("seed", range(8))
def test_plans_of_many_pieces(seed):
    draw = np.random.default_rng(seed)
    lengths = np.clip(draw.lognormal(5, 1.2, draw.integers(1, 4000)).astype(int) + 1, 1, 1024)
    counts = np.bincount(lengths, minlength=1025)
    plan = packing.plan_packing(counts, 1024)
    check(plan, counts)
    assert plan.sequences <= -(-lengths.sum() // 1024) * 1.02 + 1


def test_empty_plan():
    assert packing.plan_packing(np.zeros(11, int), 10).sequences == 0


def test_round_trip(spark):
    long = " ".join(words(1, 5000))
    rows = ODD + [(i, " ".join(words(i, i * 7))) for i in range(60)] + [(70, long), (71, "it's <|endoftext|> A B é — 100%"), (3, "again"), (3, "again")]
    got = packing.pack(frame(spark, rows, extra=True).repartition(3), pack_tokenizer(), 512).collect()
    encoder = tokenizers.Tokenizer.from_file(pack_tokenizer())
    wanted = []
    for i, text, *_ in rows:
        ids = np.array([*encoder.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        wanted += [(i, k // 512, k, len(ids[k : k + 512]), zlib.crc32(ids[k : k + 512].tobytes())) for k in range(0, len(ids), 512)]
    assert sorted(tuple(r)[:5] for r in got) == sorted(wanted)
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in by_sequence.values():
        ends = np.cumsum([n for _, n in sorted(pieces)])
        assert [o for o, _ in sorted(pieces)] == [0, *ends[:-1]] and ends[-1] <= 512
    assert len(by_sequence) <= -(-sum(r["length"] for r in got) // 512) + 1
    assert packing.pack(frame(spark, []), pack_tokenizer()).count() == 0


def test_long_words_of_two_alternating_letters(spark):
    from test_text import alternating

    encoder = tokenizers.Tokenizer.from_file(pack_tokenizer())
    texts = ["".join(alternating(1024, flip, "a", "b")) for flip in (False, True)]
    got = {r["doc_id"]: r["ids_crc32"] for r in packing.pack(frame(spark, list(enumerate(texts))), pack_tokenizer()).collect()}
    for k, text in enumerate(texts):
        ids = [*encoder.encode(text, add_special_tokens=False).ids, 1]
        assert got[k] == zlib.crc32(np.array(ids, "<u4").tobytes())
