import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import mixing

from corpora import ODD, WORD, frame, result, words


def rows(seed):
    draw = random.Random(seed)
    out, sources = list(ODD), ["a", "B", "é", "zz", None, "hot"]
    for i in range(300):
        source = "hot" if i % 3 == 0 else draw.choice(sources)
        out.append((i, "  ".join(words(i, draw.choice([0, 1, 5, 40, 300]))), "en", source, 1))
    return out


def wanted_targets(sizes, weights=(5, 2, 1), most=3):
    """Share by weight; cap; share the excess among the others; again until none is above."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    target, capped, total = {}, set(), sum(sizes.values())
    while True:
        left = total - sum(most * sizes[s] for s in capped)
        open_ = sum(weight[s] for s in order if s not in capped)
        target = {s: most * sizes[s] if s in capped else left * weight[s] / open_ for s in order}
        above = {s for s in order if target[s] > most * sizes[s] + 1e-9}
        if not above:
            return target
        capped |= above


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("block", [7, 64])
def test_sizes_and_targets(spark, seed, block):
    given = rows(seed) + [(700, "twice here", "en", "a", 1), (700, "twice here", "en", "a", 1)]
    docs = frame(spark, given, extra=True)
    got = mixing.mixed_sizes(docs, block=block)
    assert len(got.collect()) == len(given) and result(got) == result(mixing.mixed_sizes(docs.repartition(5), block=block))
    sizes = Counter()
    for _, text, _, source, _ in given:
        sizes[source] += len(WORD.findall(text or ""))
    target = wanted_targets(sizes)
    texts = Counter((r[0], len(WORD.findall(r[1] or ""))) for r in given)
    assert Counter((r["doc_id"], r["size"]) for r in got.collect()) == texts
    taken, by_id = Counter(), {r[0]: r[3] for r in given}
    for r in got.collect():
        source = by_id[r["doc_id"]]
        assert r["source_size"] == sizes[source] and r["target"] == pytest.approx(target[source])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[source] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in sizes)


def test_the_mix_holds_the_taken_words(spark):
    docs = frame(spark, rows(3), extra=True)
    sizes = {r["doc_id"]: r["taken"] for r in mixing.mixed_sizes(docs).collect()}
    mixed = mixing.mixture(docs)
    assert mixed.columns == docs.columns
    texts = {r["doc_id"]: WORD.findall(r["text"] or "") for r in docs.collect()}
    words_, passes = Counter(), Counter()
    for r in mixed.collect():
        mine = WORD.findall(r["text"])
        words_[r["doc_id"]] += len(mine)
        passes[r["doc_id"]] += 1
        whole = iter(texts[r["doc_id"]])
        assert all(any(w == x for x in whole) for w in mine)  # the words in their order
        assert r["n_chars"] == len(r["text"]) and r["src"] == "own src"
    assert {i: n for i, n in sizes.items() if n} == dict(words_) and max(passes.values()) <= 3


def test_shards_hold_every_slot_once(spark):
    placed = mixing._placed(frame(spark, rows(4)))
    targets = mixing._targets(placed, (5, 2, 1), 1.0, 3, 16)
    slots = mixing.mixture_slots(placed, targets, 16, shard_slots=32)
    per_source = {r["src"]: r["slots"] for r in targets.collect()}
    found = Counter(r["src"] for r in slots.select("src", "slot").distinct().collect())
    assert {s: n for s, n in per_source.items() if n} == dict(found) and slots.count() == sum(per_source.values())
    assert slots.groupBy("src", "pass", "index").count().filter("count > 1").count() == 0
    assert slots.select("shard").distinct().count() > 3


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000])
def test_permutation(spark, n):
    df = spark.range(n).select("id", mixing._permuted(F.col("id"), F.lit(n), F.lit("s"), F.lit(0)).alias("to"))
    back = df.select("id", mixing._permuted(F.col("to"), F.lit(n), F.lit("s"), F.lit(0), back=True).alias("from"))
    assert sorted(r["to"] for r in df.collect()) == list(range(n))
    assert all(r["id"] == r["from"] for r in back.collect())


def test_nothing_to_mix(spark):
    assert mixing.mixed_sizes(frame(spark, [])).count() == 0 and mixing.mixture(frame(spark, [])).count() == 0
    assert [(r["taken"], r["target"]) for r in mixing.mixed_sizes(frame(spark, ODD[:3])).collect()] == [(0, 0.0)] * 3


def test_no_python_in_the_plan(spark):
    plan = mixing.mixed_sizes(frame(spark, rows(5)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan
