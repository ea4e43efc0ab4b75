"""Mixing sources to target weights, with DataFrame functions only.

Every source is one stream of words, its documents in a pseudorandom order, cut into blocks of
``block`` words.  A source's target gives its number of slots; the slots are thrown over the output
shards by hash, so a shard's counts by source are multinomial draws, given each source's total.  A
shard's counts number its slots of a source; slot q takes the block whose index is the image of q
under a pseudorandom permutation, another for each pass over the source (a swap-or-not network, which
needs no table), and blocks are joined by (source, index).  The last slot of a source takes only the
words that its target still lacks.

Defined results: null and blank texts have size 0 and are never taken; a null source is one of its own,
after all others; repeated rows are separate documents; sources without words have target 0; an empty
table gives no rows; other columns are ignored by ``mixed_sizes`` and passed through by ``mixture``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .storage import bucket_count, written
from .text import WORD

WEIGHTS, MOST, BLOCK, SHARD_SLOTS, ROUNDS = (5, 2, 1), 3, 256, 4096, 24


def _permuted(index: Column, n: Column, *key: Column, back: bool = False) -> Column:
    """The image of ``index`` under a permutation of 0..n-1 that the key selects; ``back`` inverts it."""

    def swap(x: Column, i: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(*key, i), n) - x, n)
        return F.when(F.pmod(F.xxhash64(*key, i, F.greatest(x, partner), F.lit(1)), F.lit(2)) == 1, partner).otherwise(x)

    steps = (ROUNDS, 1, -1) if back else (1, ROUNDS, 1)
    return F.aggregate(F.sequence(*map(F.lit, steps)), index.cast("long"), swap)


def _placed(docs: DataFrame) -> DataFrame:
    """doc_id, code, src, size and start: the document's first word in its source's stream."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("code"),
        F.when(F.col("source").isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col("source").cast("string"))).alias("src"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )
    n = bucket_count(docs.count())
    rows = written(rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "code", F.lit(2)), F.lit(n))), "sizes")
    part = rows.groupBy("src", "bucket").agg(F.sum("size").alias("words"))
    ahead = Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = written(part.select("src", "bucket", F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("base")), "bucket-offsets")
    inside = Window.partitionBy("src", "bucket").orderBy("doc_id", "code", "size").rowsBetween(Window.unboundedPreceding, 0)
    return written(
        rows.withColumn("upto", F.sum("size").over(inside)).join(base, ["src", "bucket"])
        .select("doc_id", "code", "src", "size", (F.col("base") + F.col("upto") - F.col("size")).alias("start")),
        "placed",
    )


def _targets(placed: DataFrame, weights: tuple[float, ...], share: float, most: float, block: int) -> DataFrame:
    """One row per source: size, target, quota in words, and how its slots divide into passes and blocks.

    Targets are proportional to the weights and stop at ``most`` times the size; a target is thus the
    smaller of that and a common level times the weight.  With sources in order of size over weight,
    those that stop come first.
    """
    everything = Window.partitionBy(F.lit(0))
    by_name = everything.orderBy(F.col("src") == "-", "src")
    by_ratio = everything.orderBy("ratio", "src").rowsBetween(Window.unboundedPreceding, -1)
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    sources = (
        placed.groupBy("src").agg(F.sum("size").alias("source_size"))
        .withColumn("weight", F.element_at(cycle, F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))).cast("int") + 1))
        .withColumn("most", F.col("source_size") * F.lit(float(most)))
        .withColumn("ratio", F.col("most") / F.col("weight"))
        .withColumn("left", F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("most").over(by_ratio), F.lit(0.0)))
        .withColumn("open", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(by_ratio), F.lit(0.0)))
        .withColumn("level", F.col("left") / F.col("open"))
        .withColumn("common", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "src", "level"))).over(everything)["level"])
        .withColumn("target", F.least("most", F.coalesce(F.col("common") * F.col("weight"), F.col("most"))))
    )
    size, quota = F.greatest("source_size", F.lit(1)), F.least(F.floor(F.col("target") + 0.5), F.floor("most"))
    whole = F.lit(block).cast("long")
    return written(
        sources.withColumn("quota", quota).withColumn("passes", F.floor(F.col("quota") / size))
        .withColumn("rest", F.col("quota") - F.col("passes") * size)
        .withColumn("blocks", F.ceil(size / whole))
        .withColumn("lack", F.col("blocks") * whole - size)  # words by which the last block is shorter
        .withColumn("tail", _permuted(F.col("blocks") - 1, F.col("blocks"), F.col("src"), F.col("passes"), back=True))
        .withColumn("more", F.when(F.col("rest") <= F.col("tail") * whole, F.ceil(F.col("rest") / whole))
                    .otherwise(F.ceil((F.col("rest") + F.col("lack")) / whole)))
        .withColumn("slots", F.when(F.col("source_size") > 0, F.col("passes") * F.col("blocks") + F.col("more")).otherwise(F.lit(0)))
        .withColumn("last_words", F.col("rest") - (F.col("more") - 1) * whole + F.when(F.col("tail") < F.col("more") - 1, F.col("lack")).otherwise(F.lit(0)))
        .select("src", "source_size", "target", "passes", "blocks", "more", "slots", "last_words"),
        "targets",
    )


def mixture_slots(placed: DataFrame, targets: DataFrame, block: int = BLOCK, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """The mix itself: shard, src, slot, pass, index (block of the source), words (taken from the block's begin)."""
    number = F.greatest(F.ceil(F.sum("slots").over(Window.partitionBy(F.lit(0))) / shard_slots), F.lit(1))
    shards = targets.withColumn("shards", number)
    # every block's first word lies in one document, which thus yields the block's slots, one for each pass
    first, last = F.ceil(F.col("start") / block), F.ceil((F.col("start") + F.col("size")) / block) - 1
    begins = placed.where(first <= last).select("src", F.explode(F.sequence(first, last)).alias("i")).join(shards, "src")
    draws = (
        begins.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("passes"))).alias("turn"))
        .withColumn("q", F.col("turn") * F.col("blocks") + F.col("i")).where("q < slots").groupBy("src", F.pmod(F.xxhash64("src", "q", F.lit(3)), F.col("shards")).alias("shard"))
        .agg(F.count("*").alias("n"))
    )
    ahead = Window.partitionBy("src").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    # a few counts stand for many slots: they are dealt out before they become rows
    tasks = int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numbered = draws.withColumn("from", F.coalesce(F.sum("n").over(ahead), F.lit(0))).repartition(tasks, "src", "shard")
    slots = numbered.select("src", "shard", F.explode(F.sequence(F.col("from"), F.col("from") + F.col("n") - 1)).alias("slot")).join(targets, "src")
    turn = F.floor(F.col("slot") / F.col("blocks"))
    image = _permuted(F.col("slot") % F.col("blocks"), F.col("blocks"), F.col("src"), turn)
    final = (F.col("slot") == F.col("slots") - 1) & (F.col("more") > 0)
    return slots.select(
        "shard", "src", "slot", turn.alias("pass"), image.alias("index"),
        F.when(final, F.col("last_words")).otherwise(F.lit(block)).cast("long").alias("words"),
    )


def _pieces(placed: DataFrame, slots: DataFrame, block: int) -> DataFrame:
    """Placed documents joined to the slots of their blocks: from and words of each taken piece, as document words."""
    first, last = F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)
    parts = placed.where("size > 0").select("doc_id", "code", "src", "size", "start", F.explode(F.sequence(first, last)).alias("index"))
    begin = F.greatest(F.col("index") * block - F.col("start"), F.lit(0))
    end = F.least(F.col("index") * block + F.col("words") - F.col("start"), F.col("size"))
    return parts.join(written(slots.drop("shard", "slot"), "slots"), ["src", "index"]).select(
        "doc_id", "code", "src", "size", "start", "pass", begin.alias("from"), (end - begin).alias("words")
    ).where("words > 0")


def mixed_sizes(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.0, most: float = MOST, block: int = BLOCK
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target (its source's), taken (words in the mix, repeats counted)."""
    placed = _placed(docs)
    targets = _targets(placed, weights, share, most, block)
    here = ["src", "start", "doc_id", "code", "size"]  # no two documents with words begin at the same place
    taken = _pieces(placed, mixture_slots(placed, targets, block), block).groupBy("src", "start", "size").agg(F.sum("words").alias("taken"))
    return placed.select(*here).join(taken, ["src", "start", "size"], "left").join(targets, "src").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )


def mixture(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.0, most: float = MOST, block: int = BLOCK
) -> DataFrame:
    """The mixed documents with all their columns: one row for each pass that takes words of a document.

    A pass that takes a whole document leaves its text as it is; otherwise the text is the words taken,
    joined by spaces.  ``n_chars``, where present, follows the text.
    """
    placed = _placed(docs)
    slots = mixture_slots(placed, _targets(placed, weights, share, most, block), block)
    rows = (
        _pieces(placed, slots, block).groupBy("src", "start", "doc_id", "code", "size", "pass")
        .agg(F.sum("words").alias("words"), F.sort_array(F.collect_list(F.struct("from", "words"))).alias("spans"))
        .select(F.col("doc_id").alias("__id"), F.col("code").alias("__code"), F.when(F.col("words") < F.col("size"), F.col("spans")).alias("__spans"))
    )
    same = F.col("__id").eqNullSafe(F.col("doc_id").cast("long")) & (F.xxhash64("text") == F.col("__code"))
    source = docs.withColumn("__key", F.xxhash64("text")).dropDuplicates(["doc_id", "__key"]).drop("__key")
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    cut = F.array_join(F.flatten(F.transform("__spans", lambda s: F.slice(words, (s["from"] + 1).cast("int"), s["words"].cast("int")))), " ")
    text = F.when(F.col("__spans").isNull(), F.col("text")).otherwise(cut)
    out = source.join(rows, same).withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
