"""Small made-up corpora for the tests of text operators."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# names that operators use inside
CLASHES = ("code", "n", "part", "bucket", "block", "node", "label", "start", "size", "src", "kind", "a", "b", "pos", "rank")
ODD = [(9001, None, None, None, None), (9002, "", "en", "s1", 0), (9003, " \n\t ", "en", None, 4), (9004, "one", "en", "s1", 3),
       (9005, "Ünï é世界 \U0001f600", "de", "s2", 9)]


def words(seed: int, n: int, vocabulary: int = 300) -> list[str]:
    draw = random.Random(seed)
    pool = ["".join(draw.choice(["ba", "ke", "li", "mo", "ru", "sen"]) for _ in range(draw.randint(1, 4))) for _ in range(vocabulary)]
    return [draw.choice(pool) for _ in range(n)]


def frame(spark, rows, extra: bool = False):
    """Rows (doc_id, text[, lang, source, n_chars]) as documents; ``extra`` adds columns with clashing names."""
    full = [(*r, *([None] * (5 - len(r)))) for r in rows]
    df = spark.createDataFrame(full, SCHEMA)
    return df.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHES]) if extra else df


def result(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
