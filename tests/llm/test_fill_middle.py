import hashlib
import random
import re

import numpy as np
import pyarrow as pa

from corpora import ODD, frame, result, words
from ledgerlake.llm import fill_middle as fm
from ledgerlake.llm.packed import whole_block

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def expected(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    tokens = TOKEN.findall(text)
    n = len(tokens)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = ("".join(x) for x in (tokens[:a], tokens[a:b], tokens[b:]))
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return doc_id, n, "plain", None, None, text
    if h[3] % 100 < 80:
        return doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def corpus():
    draw = random.Random(3)
    rows = list(ODD) + [(None, "no id at all"), (None, None)]
    for i in range(300):
        body = words(i, draw.choice([1, 2, 7, 40]))
        rows.append((i, "".join(w + draw.choice([" ", "\n\n", "\t ", "  ", "é ", "\U0001f600 "]) for w in body)))
    rows += [(400 + i, f"a < b <{x}<P") for i, x in enumerate(["<S", "P", "M>", "<<"])] + [(500 + i, f"x <{m}> y z") for i, m in enumerate("PSM")]
    rows += [(600 + i, "<S" + "< S> <<P <M" * i) for i in range(20)]
    rows += [(700, " ".join(words(700, 60_000))), (701, "é" * 300_000), (702, " " * 100_000), (703, "x " * 50_000)]
    return rows + rows[10:20]  # repeated rows


def test_against_brute_force(spark):
    rows = corpus()
    got = result(fm.filled_in_middle(frame(spark, rows, extra=True)))
    assert got == sorted((expected(r[0], r[1]) for r in rows), key=repr)
    forms = [r[2] for r in got]
    assert min(forms.count(f) for f in ("plain", "psm", "spm")) > 5


def test_texts_come_back(spark):
    from pyspark.sql import functions as F

    rows = corpus()
    found = fm.filled_in_middle(frame(spark, rows), rate=100)
    got = found.select("doc_id", fm.restored(F.col("output"), F.col("form")).alias("text")).collect()
    assert sorted(((r[0], r[1]) for r in got), key=repr) == sorted(((r[0], r[1] or "") for r in rows), key=repr)


def test_empty_table(spark):
    assert fm.filled_in_middle(frame(spark, [])).collect() == []


def test_lanes_skip_and_every_rank_is_reached():
    texts = [" ".join(words(1, 5000)) + " ", "", "ünï 世界\t\U0001f600 x", None, " ", "one"]
    lists = fm.SkipLists(whole_block(pa.array(texts)))
    assert len(lists.lanes) >= 5 and len(lists.lanes[2].tokens) < 600
    for t, text in enumerate(texts):
        tokens = TOKEN.findall(text or "")
        assert lists.n_tokens[t] == len(tokens)
        ranks = np.arange(len(tokens) + 1)
        want = np.concatenate([[0], np.cumsum([len(x) for x in tokens])])
        assert (lists.points_before(np.full(len(ranks), t), ranks) == want).all()


def test_each_lane_adds_up_to_the_whole_text():
    texts = [" ".join(words(k, 400)) + " é" for k in range(5)]
    lists = fm.SkipLists(whole_block(pa.array(texts)))
    for lane in lists.lanes:
        assert lane.points.sum() == sum(map(len, texts))
        assert lane.tokens[lane.tokens < fm._END].sum() <= sum(len(TOKEN.findall(t)) for t in texts)
