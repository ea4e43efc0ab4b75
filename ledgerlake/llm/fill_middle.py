"""Fill-in-the-middle transformation: documents cut at two token ranks by an indexable skip list.

A token is a word with the white space before it, or the white space after the last word.  Every text gets
a skip list over the places between its tokens.  The lowest lane links each place with the next; a place
rises into the next express lane with a chance of one in four, by a hash of its number.  Every link carries
two widths: the tokens and the code points that it skips, those of an express lane added up from the lane
below.  A cut rank is reached from the top lane: go on while the link's tokens do not pass the rank, else go
one lane down; the code points skipped on the way are the cut's place in the text.  All texts of a block
descend at once.

The cut ranks and the form of a document depend on its id and the seed alone, so reruns agree.  JVM
expressions put the parts together and take them apart again (``restored``).

Defined results: a null text is empty; an empty text and one that contains a mark stay plain; a null id
draws as the empty string; repeated rows give equal rows; very long texts take memory in proportion to
their own length; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .text import Block, blocks, mix64

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED, RATE, SUFFIX_FIRST = 42, 50, 80  # per cent: transformed at all; of these with the suffix first
_END = np.iinfo(np.int64).max  # tokens of a lane's last link: no rank goes that far


def token_ends(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Byte places between the tokens of all texts, each text's beginning included, and where each text's places begin."""
    begin, end = block.starts[:-1], block.starts[1:] - 1
    some = np.flatnonzero(block.n_words > 0)
    last = begin.copy()  # the end of the last word, or the beginning where there is none
    last[some] = block.word_to[block.words_at[some + 1] - 1]
    places = np.sort(np.concatenate([begin, block.word_to, end[last < end]]))
    return places, np.searchsorted(places, block.starts)


@dataclass
class Lane:
    """Nodes in order of place; ``below`` is each one's position in the next lower lane."""

    tokens: np.ndarray
    points: np.ndarray
    below: np.ndarray


class SkipLists:
    """One indexable skip list for each text of a block."""

    def __init__(self, block: Block) -> None:
        places, at = token_ends(block)
        self.n_tokens = np.diff(at) - 1
        owner_first = np.repeat(at[:-1], np.diff(at))
        number = np.arange(len(places)) - owner_first  # of a place within its text
        first_bytes = np.concatenate([[0], np.cumsum((block.data & 0xC0) != 0x80)])
        points = np.diff(first_bytes[places], append=0)
        last = at[1:] - 1
        points[last] = 0
        tokens = np.ones(len(places), np.int64)
        tokens[last] = _END
        draw = mix64(number.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        self.lanes, head = [Lane(tokens, points, np.arange(len(places)))], number == 0
        while len(head) and (draw[~head] & np.uint64(3) == 0).any():
            stay = np.flatnonzero(head | (draw & np.uint64(3) == 0))  # heads rise into every lane
            low = self.lanes[-1]
            skipped = np.add.reduceat(np.where(low.tokens == _END, 0, low.tokens), stay)
            head, draw = head[stay], draw[stay] >> np.uint64(2)
            ends = np.append(head[1:], True)
            self.lanes.append(Lane(np.where(ends, _END, skipped), np.add.reduceat(low.points, stay), stay))
        self._heads = np.flatnonzero(head)

    def points_before(self, text: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The code points before the cut that has ``rank`` tokens before it."""
        at, left = self._heads[text], rank.astype(np.int64)
        points = np.zeros(len(at), np.int64)
        for lane in reversed(self.lanes):
            while len(go := np.flatnonzero(lane.tokens[at] <= left)):
                left[go] -= lane.tokens[at[go]]
                points[go] += lane.points[at[go]]
                at[go] += 1
            at = lane.below[at]
        return points


def _cuts(docs: DataFrame, seed: int) -> DataFrame:
    """doc_id, text, h3, h4, n and the code points before both cuts."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *draws)

    def cut(batches):
        for batch in batches:
            for first, last, block in blocks(batch.column(1)):
                part = batch.slice(first, last - first)
                lists, texts = SkipLists(block), np.arange(len(block))
                n = lists.n_tokens
                ranks = [part.column(k).to_numpy() % (n + 1) for k in (2, 3)]
                both = [lists.points_before(texts, f(*ranks)) for f in (np.minimum, np.maximum)]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(k) for k in (0, 1, 4, 5)), *map(pa.array, (n, *both))], ["doc_id", "text", "h3", "h4", "n", "cut", "until"]
                )

    return given.mapInArrow(cut, "doc_id long, text string, h3 long, h4 long, n long, cut long, until long")


def filled_in_middle(docs: DataFrame, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """One row per document: doc_id, n (tokens), form (plain, psm, spm), prefix_chars, middle_chars, output."""
    text = F.col("text")
    marked = text.contains(PREFIX) | text.contains(SUFFIX) | text.contains(MIDDLE)
    plain = (text == "") | marked | (F.col("h3") % 100 >= rate)
    form = F.when(plain, "plain").when(F.col("h4") % 100 < suffix_first, "spm").otherwise("psm")
    prefix = F.substr(text, F.lit(1), F.col("cut").cast("int"))
    middle = F.substr(text, F.col("cut").cast("int") + 1, (F.col("until") - F.col("cut")).cast("int"))
    suffix = F.substr(text, F.col("until").cast("int") + 1)
    p, s, m = (F.concat(F.lit(mark), part) for mark, part in ((PREFIX, prefix), (SUFFIX, suffix), (MIDDLE, middle)))
    output = F.when(F.col("form") == "plain", text).when(F.col("form") == "spm", F.concat(s, p, m)).otherwise(F.concat(p, s, m))
    moved = F.col("form") != "plain"
    return _cuts(docs, seed).withColumn("form", form).select(
        "doc_id", "n", "form", F.when(moved, F.col("cut")).alias("prefix_chars"),
        F.when(moved, F.col("until") - F.col("cut")).alias("middle_chars"), output.alias("output"),
    )


def restored(output: Column, form: Column) -> Column:
    """The text that an output of a form was made from; the marks occur nowhere else in it."""
    spm = form == "spm"
    second = F.when(spm, F.lit(PREFIX)).otherwise(F.lit(SUFFIX))
    cut = F.call_function("locate", second, output, F.lit(4))
    until = F.call_function("locate", F.lit(MIDDLE), output, cut)
    one = F.substr(output, F.lit(4), cut - 4)
    two = F.substr(output, cut + 3, until - cut - 3)
    middle = F.substr(output, until + 3)
    return F.when(form == "plain", output).when(spm, F.concat(two, middle, one)).otherwise(F.concat(one, middle, two))
