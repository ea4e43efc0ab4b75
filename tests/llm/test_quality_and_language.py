import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import language_id, quality

from corpora import ODD, WORD, frame, words


def brute_counts(text):
    text = text or ""
    found = WORD.findall(text)
    windows = [tuple(found[i : i + 5]) for i in range(len(found) - 4)]
    twice, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if twice[w] > 1:
            covered.update(range(i, i + 5))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(found) < 10 or 100 * len(covered) > 20 * len(found)
    return len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), failed


def corpus():
    draw = random.Random(8)
    rows = list(ODD)
    for i in range(150):
        good = words(i, draw.randint(8, 120))
        if i % 4 == 0:
            text = " ".join(w + draw.choice(["###", "$", "&|"]) for w in good)
        elif i % 4 == 1:
            text = "\n".join([" ".join(good[:6])] * draw.randint(1, 4) + [" ".join(good)])
        else:
            text = " ".join(good) + "\n\n" + "ü é " * (i % 3)
        rows.append((i, text))
    return rows


def test_counts_against_brute_force(spark):
    rows = corpus() + [(3, "twice"), (3, "twice")]
    labels = spark.createDataFrame([(i, 0 if i % 4 == 0 else 1) for i in range(100)] + [(None, 1), (5, None)], "doc_id long, quality int")
    docs = frame(spark, rows, extra=True).repartition(3)
    model = quality.fit_quality(docs, labels)
    got = quality.quality_verdicts(docs, model).collect()
    texts = Counter((i, *brute_counts(t)) for i, t, *_ in rows)
    assert Counter((r["doc_id"], *[r[c] for c in quality.COUNTS], r["base_failed"]) for r in got) == texts
    assert all(r["kept"] == (not r["base_failed"] and r["score"] >= 0.5) for r in got)
    unseen = [r for r in got if 100 <= r["doc_id"] < 150 and not r["base_failed"]]
    assert np.mean([r["kept"] == (r["doc_id"] % 4 != 0) for r in unseen]) > 0.95
    left = quality.keep_good(docs, model)
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(r["doc_id"] for r in got if r["kept"])
    assert left.columns == docs.columns and {r["start"] for r in left.collect()} == {"own start"}


def test_without_labels_the_base_rules_decide(spark):
    docs = frame(spark, corpus())
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.fit_quality(docs, none)
    assert all(r["kept"] != r["base_failed"] for r in quality.quality_verdicts(docs, model).collect())
    assert quality.quality_verdicts(frame(spark, []), model).count() == 0


def test_scores_never_rise_with_falling_features():
    draw = np.random.default_rng(2)
    x = draw.random((3000, 4))
    y = ((x[:, 0] + 0.3 * np.sin(9 * x[:, 1]) + 0.2 * draw.random(3000)) < 0.6).astype(float)
    forest = quality.fit_forest(x, y, falling=(0, 1), trees=30)
    assert np.mean((forest.probability(x) > 0.5) == y) > 0.85
    for column in (0, 1):
        grid = np.repeat(x[:200], 40, axis=0)
        grid[:, column] = np.tile(np.linspace(0, 1, 40), 200)
        steps = np.diff(forest.margin(grid).reshape(200, 40), axis=1)
        assert steps.max() <= 1e-12
    free = quality.fit_forest(x, y, trees=30)
    grid = np.repeat(x[:50], 40, axis=0)
    grid[:, 1] = np.tile(np.linspace(0, 1, 40), 50)
    assert np.diff(free.margin(grid).reshape(50, 40), axis=1).max() > 0.01


def test_the_training_sample_is_bounded(spark):
    docs = frame(spark, corpus())
    labels = spark.createDataFrame([(i, i % 2) for i in range(150)], "doc_id long, quality int")
    assert quality.fit_quality(docs, labels, max_rows=1).feature.shape[0] == 0  # one label has one kind only


LANGUAGES = {"xx": ["ba", "ke", "li"], "yy": ["tor", "gru", "zin"], "zz": ["ba", "tor", "ño"]}


def spoken(lang, seed, n):
    draw = random.Random(f"{lang}{seed}")
    return " ".join("".join(draw.choice(LANGUAGES[lang]) for _ in range(draw.randint(1, 4))) for _ in range(n))


def test_languages(spark):
    rows = [(i, spoken(lang, i, 5 + i), lang) for k, lang in enumerate(LANGUAGES) for i in range(60)]
    rows = [(n, *r[1:]) for n, r in enumerate(rows)] + ODD + [(900, "123 !?", "xx"), (901, spoken("xx", 1, 50), None)]
    docs = frame(spark, rows, extra=True)
    dictionaries = language_id.fit_dictionaries(docs.filter("doc_id % 5 != 0"), dictionary_bytes=8192)
    assert {"xx", "yy", "zz"} <= set(dictionaries) and all(len(d) <= 8192 for d in dictionaries.values())
    got = {r["doc_id"]: r for r in language_id.identified(docs, dictionaries).collect()}
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got.values())
    right = [got[i]["lang_pred"] == lang for i, _, lang, *_ in rows if i < 180 and i % 5 == 0]
    assert np.mean(right) >= 0.95
    assert [got[i]["lang_pred"] for i in (9001, 9002, 9003, 900)] == ["und"] * 4 and got[900]["score"] == 0.0
    assert got[901]["lang_pred"] == "xx" and got[9004]["lang_pred"] in dictionaries
    assert any(r["rejected"] for r in got.values()) and not all(r["rejected"] for r in got.values())
    # the label of a text has no say in its own prediction
    other = language_id.identified(docs.withColumn("lang", F.lit("yy")).withColumn("source", F.lit("yy")), dictionaries)
    assert {r["doc_id"]: r["lang_pred"] for r in other.collect()} == {i: r["lang_pred"] for i, r in got.items()}


def test_nothing_learned(spark):
    none = language_id.fit_dictionaries(frame(spark, [(1, "text", None), (2, None, "xx")]))
    assert none == {}
    assert [tuple(r)[1:3] for r in language_id.identified(frame(spark, [(1, "text")]), none).collect()] == [("und", 0.0)]
    assert language_id.identified(frame(spark, []), {"xx": b"abc"}).count() == 0


def test_lines_of_two_alternating_letters_are_not_equal(spark):
    from test_text import alternating, one as one_block

    one, other = ("".join(alternating(4096, flip, "a", "b")) for flip in (False, True))
    block = one_block([f"{one}\n{other}", f"{one}\n{one}"])
    assert quality.statistics(block)[0]["n_dup_lines"].tolist() == [0, 1]


def test_languages_against_brute_force(spark):
    """Every dictionary on every text: the shortest encoding wins, ties go to the first language, repeats agree."""
    import zstandard

    rows = [(i, " ".join(words(i, 80, 60)) if i % 3 else "é" + " ".join(words(i, 3000, 60)), ("aa", "bb", "cc")[i % 3], "s", 0) for i in range(60)]
    rows += rows[:6] + [(900, "?", None, None, 0), (901, "x", None, None, 0), (902, "x" * 300_000, None, None, 0), *ODD]
    docs = frame(spark, rows, extra=True)
    found = language_id.fit_dictionaries(docs)
    found["zz"] = found["aa"]  # equal dictionaries: always a tie
    got = language_id.identified(docs, found).collect()
    assert len(got) == len(rows)
    wanted = []
    for i, text, *_ in rows:
        text = (text or "").lower()
        if not any(c.isalpha() for c in text):
            wanted.append((i, "und", 0.0))
            continue
        sizes = []
        for k, content in enumerate(found.values()):
            shared = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            shared.precompute_compress(level=language_id.LEVEL)
            sizes.append((len(zstandard.ZstdCompressor(dict_data=shared, write_content_size=False).compress(text.encode())), k))
        sizes.sort()
        wanted.append((i, list(found)[sizes[0][1]], 1 - sizes[0][0] / sizes[1][0]))
    assert sorted((r["doc_id"], r["lang_pred"], r["score"]) for r in got) == sorted(wanted)
    assert not any(r["lang_pred"] == "zz" for r in got)


def test_a_common_beginning_does_not_fill_the_dictionary(spark):
    header = "the same licence at the head of every text " * 60  # longer than a piece
    rows = [(i, header + " ".join(words(i, 2000)), "aa", "s", 0) for i in range(40)] + [(100 + i, "copied", "bb", "s", 0) for i in range(500)]
    rows += [(700 + i, " ".join(words(900 + i, 50)), "bb", "s", 0) for i in range(30)]
    found = language_id.fit_dictionaries(frame(spark, rows))
    assert found["aa"].count(b"licence") * 43 < 0.6 * len(found["aa"])
    assert found["bb"].count(b"copied") <= 1 and len(found["bb"]) > 30 * 50
