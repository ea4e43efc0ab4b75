"""Language identification by compression with a dictionary for each language.

A raw-content dictionary per language is cut from a bounded sample of labelled texts.  A text is put in
lower case and compressed whole with every dictionary; the language whose dictionary leaves the fewest bytes is
predicted, and the prediction is rejected when the next one is nearly as short.

Defined results: a null text, or one without a letter, is ``und`` with score 0; so is every text when
there is nothing to learn from; labels are compared as they are; repeated rows are judged one by one;
ties go to the language with more labelled texts; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F

DICTIONARY_BYTES, ALL_BYTES, TEXT_BYTES, LEVEL, MARGIN = 64 << 10, 32 << 20, 2048, 6, 0.01


def fit_dictionaries(
    labelled: DataFrame, dictionary_bytes: int = DICTIONARY_BYTES, all_bytes: int = ALL_BYTES, text_bytes: int = TEXT_BYTES
) -> dict[str, bytes]:
    """Dictionaries from (text, lang) rows: of each language the first different texts by hash, a piece of each.

    The sample is bounded: ``dictionary_bytes`` for a language, ``all_bytes`` for all of them, and
    ``text_bytes`` from one text, so that many texts speak.  A piece begins where another hash of its text
    says, so that what texts begin alike with does not fill the dictionary.  Copies count once.
    """
    known = labelled.where("lang is not null and text is not null and length(text) > 0").select("lang", F.lower("text").alias("text"))
    piece = F.pmod(F.xxhash64("text", F.lit("piece")), F.greatest(F.length("text") - text_bytes + 1, F.lit(1))) + 1
    hashed = known.select("lang", F.xxhash64("text").alias("h"), F.substr("text", piece.cast("int"), F.lit(text_bytes)).alias("text"))
    different = hashed.select("lang", "h").distinct().groupBy("lang").count()
    counts = {r.lang: r["count"] for r in different.orderBy(F.desc("count"), "lang").collect()}  # a row per language
    room = max(256, min(dictionary_bytes, all_bytes // max(1, len(counts))))
    texts = 4 * (-(-2 * room // text_bytes) + 8)
    # hashes below the cut are about as many as are needed, however many texts there are
    cuts = [(lang, int(-(2**63) + 2**64 * min(1.0, 4 * texts / n)) - (n <= 4 * texts)) for lang, n in counts.items()]
    cut = F.broadcast(labelled.sparkSession.createDataFrame(cuts, "lang string, cut long"))
    out = _bodies(hashed.join(cut, "lang").where("h <= cut"), texts, room)
    for lang in counts:  # all hashes may lie above the cut, unlikely as that is
        if lang not in out:
            few = hashed.where(F.col("lang") == lang).groupBy("lang").agg(F.min(F.struct("h", "text")).alias("x"))
            out |= _bodies(few.select("lang", "x.h", "x.text"), texts, room)
    return {lang: out[lang] for lang in counts}


def _bodies(sample: DataFrame, texts: int, room: int) -> dict[str, bytes]:
    """The first texts by hash of each language, joined and cut at ``room`` bytes."""
    first = Window.partitionBy("lang").orderBy("h", "text")
    listed = (
        sample.distinct().withColumn("n", F.row_number().over(first)).where(F.col("n") <= texts)
        .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("n", "text"))).alias("texts"))
    )
    return {row.lang: b"".join(x.text.encode() + b"\n" for x in row.texts)[:room] for row in listed.toLocalIterator()}


def identified(docs: DataFrame, dictionaries: dict[str, bytes], margin: float = MARGIN, level: int = LEVEL) -> DataFrame:
    """One row per document: doc_id, lang_pred, score, rejected.

    The score is the share of the second shortest encoding that the shortest saves; below ``margin``
    the prediction is marked as rejected.
    """
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)  # at most ``all_bytes``

    def predict(batches):
        names = list(shared.value)
        coders = []
        for name in names:
            content = zstandard.ZstdCompressionDict(shared.value[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=level)
            coders.append(zstandard.ZstdCompressor(dict_data=content, write_content_size=False).compress)
        for batch in batches:
            predicted, scores = [], []
            texts = pc.cast(batch.column(1), pa.large_binary())
            for text, letters in zip(texts, batch.column(2).to_pylist(), strict=True):
                if not letters or not names:
                    predicted.append("und")
                    scores.append(0.0)
                    continue
                raw = text.as_buffer()
                sizes = sorted((len(code(raw)), i) for i, code in enumerate(coders))
                predicted.append(names[sizes[0][1]])
                scores.append(1 - sizes[0][0] / sizes[1][0] if len(sizes) > 1 else 1.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(predicted, pa.string()), pa.array(scores, pa.float64()),
                 pa.array([s < margin for s in scores])],
                ["doc_id", "lang_pred", "score", "rejected"],
            )

    letters: Column = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower("text").alias("text"), letters.alias("letters")).mapInArrow(
        predict, "doc_id long, lang_pred string, score double, rejected boolean"
    )
