"""The main text of web pages: a recurrent labeller trained here on pages whose markup tells what they hold.

No table says which blocks are main text, so the labeller learns from markup: in a bounded sample of pages a
block is main text if an element on its path is an article (by tag, class or id) and none is a menu, advert,
notice, form or the like.  Pages that name no article teach nothing.  The sampled texts are also put
together anew: in other containers, with sidebars, notices, forms and reader comments around and within the
article, some with all names taken away, so that place, words and neighbours have to tell.  The model is
small and goes to every task; every page is read whole there, and nothing is shuffled.

Defined results: a null or empty page and one without main text have an empty text; repeated rows give equal
rows; long pages take memory in proportion to their own length; with no page to learn from, the
labeller learns from the invented pages alone; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .block_labeller import BlockLabeller, features
from .html_blocks import Leaf, leaf_blocks, name_id

SAMPLE, SAMPLE_CHARS, REMADE = 300, 1 << 16, 3  # pages to learn from, their greatest length, invented pages for each
# Names that pages give to their parts, tags plain and parts of classes and ids after a dot.
ARTICLE = ("article", "main", ".article", ".content", ".post", ".entry", ".story", ".body", ".text", ".main", ".prose")
OTHER = {
    "menu": ("nav", "menu", ".nav", ".navbar", ".menu", ".navigation", ".breadcrumb", ".breadcrumbs", ".toc", ".pagination", ".tabs", ".links", ".skip"),
    "header": ("header", ".header", ".masthead", ".topbar", ".banner", ".logo", ".branding", ".toolbar"),
    "footer": ("footer", ".footer", ".copyright", ".legal", ".colophon", ".bottom", ".credits"),
    "sidebar": ("aside", ".sidebar", ".side", ".widget", ".related", ".recommended", ".popular", ".trending", ".archive", ".tags", ".rail",
                ".more", ".readmore", ".author", ".bio", ".share", ".social", ".sharing"),
    "notice": ("dialog", ".notice", ".cookie", ".cookies", ".consent", ".gdpr", ".alert", ".popup", ".modal", ".overlay", ".warning", ".paywall", ".disclaimer",
               ".message", ".privacy", ".toast"),
    "advert": (".ad", ".ads", ".advert", ".advertisement", ".adsense", ".sponsor", ".sponsored", ".promo", ".promotion", ".banner", ".affiliate"),
    "form": ("form", "fieldset", "button", "select", "textarea", "legend", ".form", ".newsletter", ".subscribe", ".subscription", ".signup", ".login", ".search", ".contact"),
    "comments": (".comment", ".comments", ".commentlist", ".reply", ".replies", ".respond", ".discussion", ".disqus", ".reviews", ".responses", ".thread"),
}
_ARTICLE_IDS = frozenset(map(name_id, ARTICLE[:6]))
_OTHER_IDS = frozenset(name_id(n) for names in OTHER.values() for n in names)
_FILLER = ("Words of no page stand here.", "More of them follow, and then an end.", "Short line")


def told_by_markup(page: list[Leaf]) -> np.ndarray | None:
    """1 for main text, 0 for other blocks, or None where the markup names no article."""
    inside = [bool(leaf.path & _ARTICLE_IDS) and not leaf.path & _OTHER_IDS for leaf in page]
    return np.array(inside, float) if any(inside) else None


def _leaf(names: list[str], tag: str, text: str, linked: bool = False) -> Leaf:
    return Leaf(frozenset(map(name_id, [*names, tag])), name_id(f"leaf:{tag}"), text, len(text) if linked else 0)


def _region(kind: str, draw: random.Random, pool: list[str], outer: list[str]) -> list[Leaf]:
    """Blocks of a menu, an advert, comments and so on, with texts of other pages."""
    name = draw.choice(OTHER[kind])
    names = [*outer, draw.choice(["div", "section", "ul"]), name] + ([draw.choice(OTHER[kind])] if draw.random() < 0.3 else [])
    long = kind in ("comments", "notice", "sidebar", "advert")
    out = []
    for _ in range(draw.randint(1, 8 if kind in ("menu", "comments", "sidebar") else 3)):
        text = draw.choice(pool)
        if not long or draw.random() < 0.4:
            text = " ".join(text.split()[: draw.randint(1, 6)]) or text
        out.append(_leaf(names, draw.choice(["li", "p", "div", "td", "h3", "h4", "label"] if draw.random() < 0.7 else [name.lstrip(".")]), text,
                         linked=kind in ("menu", "sidebar") and draw.random() < 0.7))
    return out


def remade(article: list[str], pool: list[str], draw: random.Random) -> tuple[list[Leaf], np.ndarray]:
    """The paragraphs of an article in a page of invented layout, and which blocks they are."""
    outer = ["html", "body", *draw.choice([[], ["div", ".wrapper"], ["div", ".container", ".page"], ["table", "tr", "td"]])]
    bare = draw.random() < 0.25  # the article's container has no telling name
    names = [*outer, "div"] if bare else [*outer, "div", *draw.sample(ARTICLE, draw.randint(1, 2))]
    blocks: list[tuple[Leaf, int]] = []
    add = lambda kind, where: blocks.extend((leaf, 0) for leaf in _region(kind, draw, pool, where))
    for kind in ("header", "menu", "notice", "advert", "sidebar", "form"):
        if draw.random() < 0.45:
            add(kind, names if draw.random() < 0.3 else outer)
    for k, text in enumerate(article):
        tag = "h1" if k == 0 and draw.random() < 0.6 else draw.choice(["p"] * 12 + ["h2", "li", "blockquote", "div", "td", "pre"])
        blocks.append((_leaf(names, tag, text), 1))
        if draw.random() < 0.08:
            add(draw.choice(["advert", "sidebar", "form", "notice"]), names)
    for kind in ("sidebar", "comments", "form", "notice", "advert", "menu", "footer"):
        if draw.random() < 0.45:
            add(kind, names if draw.random() < 0.4 else outer)
    page, labels = [leaf for leaf, _ in blocks], np.array([kept for _, kept in blocks], float)
    if draw.random() < 0.05:  # no names at all
        page = [leaf._replace(path=frozenset()) for leaf in page]
    return page, labels


def fit_labeller(pages: DataFrame, sample: int = SAMPLE, seed: int = 0) -> BlockLabeller:
    """Trained on the driver on at most ``sample`` pages of least hash, none longer than ``SAMPLE_CHARS``."""
    known = pages.select("html", F.xxhash64("html").alias("h")).where(F.length("html").between(1, SAMPLE_CHARS))
    least = F.broadcast(known.select("h").distinct().orderBy("h").limit(sample))  # hashes travel, pages do not
    chosen = known.join(least, "h").dropDuplicates(["h"]).orderBy("h").collect()
    draw, read = random.Random(seed), [leaf_blocks(r["html"]) for r in chosen]
    told = [(page, labels) for page in read if (labels := told_by_markup(page)) is not None]
    pool = [leaf.text for page in read for leaf in page if len(leaf.text) < 2000] or list(_FILLER)
    articles = [[leaf.text for leaf, kept in zip(page, labels, strict=True) if kept] for page, labels in told] or [list(_FILLER)] * 50
    made = [remade(draw.sample(a, len(a))[: draw.randint(1, 30)] if draw.random() < 0.5 else a[:40], pool, draw) for a in articles for _ in range(REMADE)]
    training = [(page[:200], labels[:200]) for page, labels in told + made]
    return BlockLabeller(seed).fit([page for page, _ in training], [labels for _, labels in training], seed=seed)


def main_text(pages: DataFrame, labeller: BlockLabeller) -> DataFrame:
    """One row per page: page_id, url, text, n_blocks, n_kept."""

    def extract(batches):
        for batch in batches:
            html = batch.column(2)
            sizes = np.cumsum([len(x) if x else 0 for x in html.to_pylist()]) // (4 << 20)  # a few megabytes at a time
            cuts = np.append(np.flatnonzero(np.diff(sizes, prepend=-1)), len(batch))
            for first, last in zip(cuts[:-1], cuts[1:], strict=True):
                read = [leaf_blocks(x or "") for x in html[first:last].to_pylist()]
                f = features(read)
                kept = labeller.score(f) > 0
                texts, counts = [], []
                for page, at in zip(read, f.pages_at, strict=False):
                    own = [leaf.text for leaf, keep in zip(page, kept[at : at + len(page)], strict=True) if keep]
                    texts.append("\n\n".join(own))
                    counts.append(len(own))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[first:last], batch.column(1)[first:last], pa.array(texts, pa.string()), pa.array(np.diff(f.pages_at)), pa.array(counts, pa.int64())],
                    ["page_id", "url", "text", "n_blocks", "n_kept"],
                )

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html").mapInArrow(
        extract, "page_id long, url string, text string, n_blocks long, n_kept long"
    )
