import os
import random

import numpy as np
import pyarrow as pa
import pytest

from conftest import DATA
from corpora import words
from ledgerlake.llm import block_labeller as bl, main_text as mt
from ledgerlake.llm.html_blocks import leaf_blocks, name_id

SCHEMA = "page_id long, url string, html string, text string, n_blocks string, kept string"


def sentence(seed, n=14):
    return " ".join(words(seed, n)).capitalize() + "."


def article_page(k, template):
    draw = random.Random(k)
    title, paragraphs = sentence(k, 5), [sentence(1000 * k + i, draw.randint(8, 40)) for i in range(draw.randint(2, 9))]
    menu = "".join(f"<li><a href='/{i}'>{w}</a></li>" for i, w in enumerate(words(k, 6)))
    body = f"<h1>{title}</h1>" + "".join(f"<p>{p}</p>" for p in paragraphs)
    page = template.format(menu=menu, body=body, other=sentence(k + 5000, 12), more=sentence(k + 6000, 20), name=k)
    return page, "\n\n".join([title, *paragraphs])


TEMPLATES = [
    "<html><head><title>t</title></head><body><nav><ul>{menu}</ul></nav><article>{body}</article><footer>&copy; {other}</footer></body></html>",
    "<body><div id=header><h3>{other}</h3></div><ul class='main-menu'>{menu}</ul><div class='post-content'>{body}</div>"
    "<div id='comments'><h3>Comments</h3><div class='comment'><p>{more}</p></div><div class=comment><p>{other}</p></div></div></body>",
    "<body><header><p>{other}</p></header><main><div class='ad-slot'>{other}</div>{body}<form><label>{more}</label><button>{other}</button></form></main>"
    "<aside class=sidebar><h4>More</h4><ul>{menu}</ul></aside><div class=cookie-notice><p>{more}</p></div></body>",
]


@pytest.fixture(scope="module")
def labeller(spark):
    rows = [(k, None, article_page(k, TEMPLATES[0])[0]) for k in range(120)]
    return mt.fit_labeller(spark.createDataFrame(rows, "page_id long, url string, html string"))


@pytest.mark.parametrize("template", TEMPLATES)
def test_layouts_that_were_not_in_the_sample(spark, labeller, template):
    """Blocks of held-out pages, most of them in markup that no page of the sample has."""
    right = wrong = 0
    rows = [(k, *article_page(k, template)) for k in range(3000, 3060)]
    df = spark.createDataFrame([(k, "u", page, "own", "own", "own") for k, page, _ in rows], SCHEMA)
    got = {r["page_id"]: r["text"] for r in mt.main_text(df, labeller).collect()}
    for k, _, want in rows:
        found, wanted = set(got[k].split("\n\n")), set(want.split("\n\n"))
        right, wrong = right + len(found & wanted), wrong + len(found ^ wanted)
    assert right / (right + wrong) >= 0.95


def test_blocks_of_broken_markup():
    page = (
        "<!doctype html><title>Not seen</title><script>var t = '<p>no</p>';</script><style>p{}</style><div class='Wide menuBar'>a &amp; b<br>c"
        "<p>one <b>two</b>&nbsp;\n three<p>four<!-- <p>gone</p> --> five<li>six</div></span>seven <a href='x>y'>link</a> < 8 &lt;p&gt;<img alt='n'><div"
    )
    leaves = leaf_blocks(page)
    assert [x.text for x in leaves] == ["a & b c", "one two three", "four five", "six", "seven link < 8 <p>"]
    assert {name_id(n) for n in ("div", ".wide", ".menu", ".bar")} <= leaves[0].path and leaves[0].own == name_id("leaf:div")
    assert leaves[4].linked == 4 and not leaves[4].path
    assert leaf_blocks("") == [] and leaf_blocks("<p> \n </p>") == [] and leaf_blocks("plain") [0].text == "plain"
    assert leaf_blocks("<script>never closed <p>x</p>") == [] and leaf_blocks("<p>x<!-- never closed <p>y") [0].text == "x"


def test_deep_and_long_pages_take_linear_time():
    deep = leaf_blocks("<div class=a>" * 50_000 + "x" + "</div>" * 50_000 + "</p>" * 50_000)
    assert [x.text for x in deep] == ["x"] and len(deep[0].path) == 2
    assert len(leaf_blocks("<p>word</p>" * 50_000)) == 50_000
    assert leaf_blocks("<" * 100_000 + "a \"" * 20_000)


def test_gradients_against_differences():
    pages = [leaf_blocks(article_page(k, t)[0]) for k, t in enumerate(TEMPLATES)]
    labels = np.concatenate([np.arange(len(p)) % 2 for p in pages]).astype(float)
    f, model = bl.features(pages), bl.BlockLabeller(1)
    draw = np.random.default_rng(0)
    model.p = {k: v + 0.1 * draw.normal(size=v.shape) for k, v in model.p.items()}
    found = model.gradients(f, labels)

    def loss():
        chance = 1 / (1 + np.exp(-model.score(f)))
        return -np.mean(labels * np.log(chance) + (1 - labels) * np.log(1 - chance))

    used = {"names": f.names[3], "words": f.words[5]}
    for name, value in model.p.items():
        at = (used[name], 2) if name in used else tuple(np.array(value.shape) // 2)
        before, step = value[at], 1e-5
        value[at] = before + step
        up = loss()
        value[at] = before - step
        down = loss()
        value[at] = before
        assert abs((up - down) / (2 * step) - found[name][at]) < 1e-6


def test_a_page_is_judged_alike_in_any_company(labeller):
    pages = [leaf_blocks(article_page(k, TEMPLATES[k % 3])[0]) for k in range(40)]
    f = bl.features(pages)
    together = labeller.score(f)
    alone = np.concatenate([labeller.score(bl.features([p])) for p in pages])
    assert np.allclose(together, alone, atol=1e-9)


def test_odd_pages(spark, labeller):
    long = article_page(7, TEMPLATES[0].replace("{body}", "{body}" * 2000))
    rows = [(1, None, None), (2, "u", ""), (3, "u", "<nav><a href=x>y</a></nav>"), (None, "u", article_page(9, TEMPLATES[0])[0]), (5, "u", long[0]), (5, "u", long[0])]
    df = spark.createDataFrame([(*r, "own", "own", "own") for r in rows], SCHEMA)
    got = mt.main_text(df, labeller).collect()
    assert len(got) == 6
    by = {r["page_id"]: r for r in got}
    assert by[1]["text"] == by[2]["text"] == by[3]["text"] == "" and by[None]["text"] == article_page(9, TEMPLATES[0])[1]
    assert by[5]["text"] == "\n\n".join([long[1]] * 2000) and [r["text"] for r in got if r["page_id"] == 5] == [by[5]["text"]] * 2
    assert mt.main_text(df.limit(0), labeller).collect() == []


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "u", None, "own", "own", "own")], SCHEMA)
    model = mt.fit_labeller(df)
    assert mt.main_text(df, model).first()["text"] == ""


def test_whole_table_keeps_articles(spark):
    import html as h
    import re

    from ledgerlake.llm.queries import QUERIES

    sf = os.path.join(DATA, "sf0.001")
    if not os.path.isdir(sf):
        pytest.skip("driver tables not present")
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    same = 0
    for r in QUERIES["op12_recurrent_labeller"](spark, sf).collect():
        inner = re.sub(r"</?b>|<br>", " ", re.search(r"<article>(.*?)(?:</article>|\Z)", pages[r["page_id"]], re.S).group(1))
        parts = (" ".join(h.unescape(x).split()) for x in re.split(r"<[^>]+>", inner))
        same += r["text"] == "\n\n".join(p for p in parts if p)
        assert r["n_chars"] == len(r["text"])
    assert same >= 0.98 * len(pages)
