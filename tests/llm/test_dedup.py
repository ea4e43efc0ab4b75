"""Exact, line, window, near and substring dedup against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from ledgerlake.llm import content_sort, line_dedup, near_dup, suffix_dedup
from ledgerlake.llm.components import components

from corpora import ODD, WORD, frame, result, words


def sentence(seed, n=12):
    return " ".join(words(seed, n)) + "."


# --- exact ----------------------------------------------------------------------------------------

@pytest.mark.parametrize("keep", ["min", "max"])
@pytest.mark.parametrize("partitions", [1, 7])
def test_content_sort(spark, keep, partitions):
    draw = random.Random(3)
    rows = ODD + [(i, draw.choice(["hot text " * 30, "x", "x ", "ü", sentence(i % 9)])) for i in range(200)] + [(None, "x"), (7, "same id"), (7, "same id")]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    got = content_sort.content_classes(frame(spark, rows, extra=True).repartition(5), keep).collect()
    spark.conf.set("spark.sql.shuffle.partitions", before)
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(t or "", []).append(i)
    choose = min if keep == "min" else max
    wanted = []
    for text, ids in groups.items():
        kept = choose([i for i in ids if i is not None], default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        wanted += [(i, kept, len(ids), i == kept, sha) for i in ids]
    assert sorted(map(tuple, got), key=repr) == sorted(wanted, key=repr)


def test_content_sort_normalised_and_empty(spark):
    docs = frame(spark, [(1, "A b"), (2, "a B"), (3, "c")])
    from pyspark.sql import functions as F

    assert {r["doc_id"]: r["keep_id"] for r in content_sort.content_classes(docs, normalise=F.lower).collect()} == {1: 1, 2: 1, 3: 3}
    assert content_sort.content_classes(frame(spark, [])).count() == 0


# --- lines ----------------------------------------------------------------------------------------

def test_units(spark):
    a, b, c = sentence(1), sentence(2), sentence(3)
    rows = [
        (1, f"{a} {b}\n{c}"), (2, f"{c.upper()}"), (3, f"New words come before it all. {a}  Ba ke. {b} Li mo."),
        (4, "Ba ke."), (5, None), (6, ""), (7, f"{c}\n{c}"), (8, "Ba ke."),
    ]
    got = {r["doc_id"]: r for r in line_dedup.unit_dedup(frame(spark, rows, extra=True)).collect()}
    assert {i: (r["n_units"], r["n_removed"], r["kept_text"]) for i, r in got.items()} == {
        1: (3, 0, rows[0][1]), 2: (1, 1, ""), 3: (5, 2, "New words come before it all. Ba ke. Li mo."), 4: (1, 0, "Ba ke."),
        5: (0, 0, ""), 6: (0, 0, ""), 7: (2, 2, ""), 8: (1, 1, ""),
    }
    for i, text in rows:
        raw = (text or "").encode()
        spans = [(s["start"], s["end"]) for s in got[i]["removed"]]
        kept = b"".join(raw[e:s] for e, s in zip([0, *[x[1] for x in spans]], [*[x[0] for x in spans], len(raw)], strict=True))
        assert kept.decode() == got[i]["kept_text"]


def test_paragraphs(spark):
    a, b = sentence(1) + "\n" + sentence(2), sentence(3)
    docs = frame(spark, [(1, f"{a}\n\n{b}"), (2, f"{b}\n \n{a}\n\n{sentence(2)}")])
    got = {r["doc_id"]: r["n_removed"] for r in line_dedup.unit_dedup(docs, (line_dedup.PARAGRAPH,)).collect()}
    assert got == {1: 0, 2: 2}
    assert line_dedup.unit_dedup(frame(spark, [])).count() == 0


def brute_windows(rows):
    seen, gone = set(), {}
    for i, t in sorted(rows):
        lines = (t or "").split("\n")
        full = [(k, tuple(WORD.findall(x))) for k, x in enumerate(lines) if WORD.findall(x)]
        gone[i] = set()
        for (k, x), (_, y), (last, z) in zip(full, full[1:], full[2:], strict=False):
            if (x, y, z) in seen:
                gone[i].update(range(k, last + 1))
            seen.add((x, y, z))
    return {i: "\n".join(x for k, x in enumerate((t or "").split("\n")) if k not in gone[i]) for i, t in rows}


def test_windows(spark):
    draw = random.Random(5)
    lines = [sentence(k, 4) for k in range(12)] + ["", "  "]
    rows = [(i, "\n".join(draw.choice(lines[:4] if i % 3 else lines) for _ in range(draw.randint(0, 30)))) for i in range(80)]
    rows += [(200, None), (201, ""), (202, "a\na\na\na\na")]
    docs = frame(spark, rows, extra=True)
    wanted = brute_windows(rows)
    assert {r["doc_id"]: r["kept_text"] for r in line_dedup.window_dedup(docs).collect()} == wanted
    left = {r["doc_id"]: r for r in line_dedup.without_repeated_windows(docs).collect()}
    texts = dict(rows)
    assert set(left) == {i for i, t in wanted.items() if WORD.search(t) or t == (texts[i] or "")}
    assert all((left[i]["text"] or "") == wanted[i] and left[i]["code"] == "own code" for i in left)
    assert line_dedup.window_dedup(frame(spark, [])).count() == 0


def test_repeated_rows_keep_the_same_parts(spark):
    text = "\n".join(sentence(k) for k in range(4))
    docs = frame(spark, [(1, text), (1, text), (2, text)])
    assert sorted(r["n_removed"] for r in line_dedup.window_dedup(docs).collect()) == [0, 0, 4]


# --- near duplicates ------------------------------------------------------------------------------

def shingle_weights(text):
    w = WORD.findall(text or "")
    found = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])
    return {k: 1 + np.log(c) for k, c in found.items()}


def similarity(x, y):
    """The probability Jaccard similarity by its definition."""
    both, total = x.keys() & y.keys(), x.keys() | y.keys()
    return sum(1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in total) for i in both)


def brute_classes(rows):
    sets = [shingle_weights(t) for _, t, *_ in rows]
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i].keys() & sets[j].keys())
            if both * 3 >= len(sets[i]) and similarity(sets[i], sets[j]) >= 0.8 - 1e-9:  # much less cannot reach 0.8 here
                parent[max(top(i), top(j))] = min(top(i), top(j))
    return [top(i) for i in range(len(rows))]


def corpus(seed):
    draw = random.Random(seed)
    rows, n = list(ODD), 0
    for family in range(12):
        base = words(1000 * seed + family, draw.randint(3, 400))
        for _ in range(draw.choice([1, 2, 3, 25])):
            mine = list(base)
            for _ in range(draw.choice([0, 1, 1, 2, 5, 20])):
                mine[draw.randrange(len(mine))] = draw.choice(["new", "other"])
            rows.append((n, " ".join(mine)))
            n += 1
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_near_classes(spark, seed):
    rows = corpus(seed)
    got = {r["doc_id"]: r for r in near_dup.near_classes(frame(spark, rows, extra=True)).collect()}
    tops = brute_classes(rows)
    for (i, *_), k in zip(rows, tops, strict=True):
        mine = [rows[j][0] for j in range(len(rows)) if tops[j] == k]
        assert (got[i]["class_id"], got[i]["class_size"], got[i]["kept"]) == (min(mine), len(mine), i == min(mine))


def test_one_of_each(spark):
    text = " ".join(words(9, 100))
    rows = [(4, text), (2, text + " more"), (2, text + " more"), (9, "alone here"), (7, None), (8, None)]
    stay = near_dup.one_of_each(frame(spark, rows, extra=True))
    assert [(r[0], r[1]) for r in result(stay.select("doc_id", "text"))] == [(2, text + " more"), (7, None), (8, None), (9, "alone here")]
    assert stay.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"] and {r["node"] for r in stay.collect()} == {"own node"}
    assert near_dup.near_classes(frame(spark, [])).count() == 0


def test_rows_of_bands_are_shuffled_once(spark, monkeypatch):
    """Without broadcasts, as for buckets too many for one, they are counted and kept in one exchange by key."""
    plans, write = {}, near_dup.written
    monkeypatch.setattr(near_dup, "written", lambda df, purpose, *rest: plans.setdefault(purpose, df) and write(df, purpose, *rest))
    near_dup.near_classes(frame(spark, [(i, sentence(i % 40, 40)) for i in range(80)]))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = plans["paired"].select("*")._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("hashpartitioning(key") == 1 and "Join" not in plan


def test_edited_copies_of_one_original(spark):
    rows, n = [], 0
    for family in range(4):
        base = [f"f{family}w{i}" for i in range(404)]  # 400 shingles
        rows.append((n, " ".join(base)))
        n += 1
        for copy in range(100):  # 0.82 to the original, about 0.68 to each other
            draw, mine = random.Random(1000 * family + copy), list(base)
            for k, at in enumerate(draw.sample(range(4, 400, 5), 8)):
                mine[at] = f"f{family}c{copy}x{k}"
            rows.append((n, " ".join(mine)))
            n += 1
    got = {r["doc_id"]: r["class_id"] for r in near_dup.near_classes(frame(spark, rows)).collect()}
    assert brute_classes(rows[:6]) == [0] * 6
    assert got == {i: i // 101 * 101 for i, _ in rows}


def test_repeats_count(spark):
    """Equal sets of shingles, of which one text repeats some: near or not by the weights, as by brute force."""
    rows = []
    for family in range(6):
        base = [f"f{family}w{i}" for i in range(404)]
        rows += [(3 * family, " ".join(base)), (3 * family + 1, " ".join(base + base[:60])),
                 (3 * family + 2, " ".join(base + [f"f{family}p{i}" for i in range(95)] * 20))]
    assert brute_classes(rows) == [i if i % 3 == 2 else i // 3 * 3 for i in range(18)]
    got = {r["doc_id"]: r["class_id"] for r in near_dup.near_classes(frame(spark, rows)).collect()}
    assert got == {i: i if i % 3 == 2 else i // 3 * 3 for i in range(18)}


def test_verdict_is_the_similarity_that_signatures_estimate():
    from test_text import one

    draw, a, b = random.Random(8), [], []
    for k in range(40):
        base = words(k, draw.randint(1, 120), 40)
        a.append(" ".join(base))
        b.append(" ".join(base[: draw.randint(0, len(base))] + words(k + 500, draw.randint(0, 30), 40) + base[:20] * draw.randint(0, 3)))
    got = near_dup.probability_jaccard(one(a), one(b))
    assert got == pytest.approx([similarity(shingle_weights(x), shingle_weights(y)) for x, y in zip(a, b, strict=True)])


def test_copies_that_are_not_near_meet_in_no_join(spark, monkeypatch):
    """Copies of an absent original at about 0.68 to each other: texts meet only in the few pairs beyond the sketches' cut."""
    compared, real = [], near_dup._verified

    def counting(pairs, *more):
        compared[-1] += pairs.count()
        return real(pairs, *more)

    monkeypatch.setattr(near_dup, "_verified", counting)
    for copies in (100, 200):
        rows = []
        for copy in range(copies):
            draw, mine = random.Random(copy), [f"w{i}" for i in range(404)]
            for k, at in enumerate(draw.sample(range(4, 400, 5), 8)):
                mine[at] = f"c{copy}x{k}"
            rows.append((copy, " ".join(mine)))
        compared.append(0)
        assert near_dup.near_classes(frame(spark, rows)).select("class_id").distinct().count() > 0.9 * copies
    assert compared[0] <= 0.05 * 100 * 99 / 2 and compared[1] <= 0.05 * 200 * 199 / 2


def test_sketches_pass_what_is_near():
    """Recall of the sketch test at the least similarity, over many pairs."""
    from test_text import one

    n, draw = 300, random.Random(2)
    a = [[f"{k}w{i}" for i in range(304)] for k in range(n)]
    b = [[*x[:270], *(f"{k}n{i}" for i in range(34))] for k, x in enumerate(a)]
    similar = near_dup.probability_jaccard(one([" ".join(x) for x in a]), one([" ".join(x) for x in b]))
    assert draw and ((similar > 0.79) & (similar < 0.81)).all()
    for registers in (near_dup.WIDE, near_dup.WIDER):
        sa, sb = (near_dup.sketches(one([" ".join(x) for x in side]), registers) for side in (a, b))
        x = sa ^ sb
        differ = np.bitwise_count((x | x >> np.uint64(1)) & np.uint64(0x5555555555555555)).sum(axis=1)
        assert (registers - differ >= near_dup.least_alike(0.8, registers)).all()


def test_signatures_estimate_probability_jaccard():
    draw = np.random.default_rng(4)
    hashes = draw.integers(0, 2**63, 300).astype(np.uint64)
    a, b = hashes[:200], hashes[100:]
    wa, wb = draw.integers(1, 6, 200).astype(float), draw.integers(1, 6, 200).astype(float)
    m = 20_000
    sign = near_dup.prob_min_hash(np.repeat([0, 1], 200), np.concatenate([a, b]), np.concatenate([wa, wb]), 2, m)
    x, y = np.concatenate([wa, np.zeros(100)]), np.concatenate([np.zeros(100), wb])
    both = np.flatnonzero((x > 0) & (y > 0))
    exact = sum(1 / np.maximum(x / x[i], y / y[i]).sum() for i in both)
    assert np.mean(sign[0] == sign[1]) == pytest.approx(exact, abs=0.015)


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 102), (101, 102), (7, 7), (200, 201), (201, 200)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100, 200: 200, 201: 200}


# --- substrings -----------------------------------------------------------------------------------

def brute_substrings(rows, length):
    seen = {}
    raws = [(i, (t or "").encode()) for i, t, *_ in rows]
    for _, raw in raws:
        for s in range(len(raw) - length + 1):
            seen[raw[s : s + length]] = seen.get(raw[s : s + length], 0) + 1
    out = []
    for i, raw in raws:
        gone = np.zeros(len(raw) + 1, bool)
        for s in range(len(raw) - length + 1):
            if seen[raw[s : s + length]] > 1:
                gone[s : s + length] = True
        kept = bytes(x for x, g in zip(raw, gone, strict=False) if not g)
        spans = int((gone[:-1] & ~np.concatenate([[False], gone[:-2]])).sum()) if raw else 0
        out.append((i, len(raw), int(gone[:-1].sum()) if raw else 0, spans, hashlib.sha256(kept).hexdigest(), kept))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_substrings(spark, seed):
    draw = random.Random(seed)
    pieces = [" ".join(words(k + 50 * seed, draw.randint(5, 60))) for k in range(12)] + ["aaaaaaaaa" * 20, "ab" * 90, "é" * 70]
    rows = ODD + [(i, draw.choice(["", "x", "ü "]).join(draw.choice(pieces) for _ in range(draw.randint(0, 6)))) for i in range(40)]
    rows += [(50, rows[-1][1]), (50, rows[-1][1])]
    docs = frame(spark, rows, extra=True).repartition(3)
    got = suffix_dedup.without_repeats(docs, length=60, reach=20, block_bytes=draw.choice([200, 5000]), parts=draw.choice([1, 9]))
    assert sorted((tuple(r)[:5] + (bytes(r[5]),) for r in got.collect()), key=repr) == sorted(brute_substrings(rows, 60), key=repr)


def test_no_substrings(spark):
    assert suffix_dedup.without_repeats(frame(spark, [])).count() == 0
    assert suffix_dedup.without_repeats(frame(spark, ODD)).agg({"n_removed": "sum"}).first()[0] == 0
    with pytest.raises(ValueError):
        suffix_dedup.without_repeats(frame(spark, ODD), length=40, reach=20)


@pytest.mark.parametrize("n_runs", [1, 2, 3, 8, 13])
def test_merging_runs(n_runs):
    draw = random.Random(n_runs)
    runs = []
    for _ in range(n_runs):
        strings = sorted("".join(draw.choice("ab") for _ in range(draw.randint(0, 12))).encode() for _ in range(draw.randint(0, 30)))
        shared, lengths, rest = suffix_dedup.front_coded(strings)
        assert suffix_dedup.decoded(shared, lengths, rest) == strings
        runs.append((strings, shared.tolist()))
    order, common = suffix_dedup.merged_runs(runs)
    merged = [runs[r][0][k] for r, k in order]
    assert merged == sorted(s for strings, _ in runs for s in strings)
    assert common == [0, *[suffix_dedup.shared_prefix(a, b, 0) for a, b in zip(merged, merged[1:], strict=False)]][: len(merged)]


@pytest.mark.parametrize("n", [1024, 4096])
def test_texts_of_two_alternating_words_are_told_apart(spark, n):
    """Sums of powers of one base agree for such texts; hashes of lines, units and documents must not."""
    from test_text import alternating

    one, other = (" ".join(alternating(n, flip)) for flip in (False, True))
    docs = frame(spark, [(1, one), (2, other), (3, one)])
    kept = {r["doc_id"]: r["kept"] for r in near_dup.near_classes(docs).collect()}
    assert kept[1] and not kept[3]
    assert kept[2] != (similarity(shingle_weights(one), shingle_weights(other)) >= 0.8)
    units = {r["doc_id"]: r["n_removed"] for r in line_dedup.unit_dedup(docs).collect()}
    assert units[1] == units[2] == 0 and units[3] == 1
    lines = frame(spark, [(k, "\n".join([t, "second line", "third"])) for k, t in ((1, one), (2, other), (3, one))])
    assert {r["doc_id"]: r["n_removed"] for r in line_dedup.window_dedup(lines).collect()} == {1: 0, 2: 0, 3: 3}

