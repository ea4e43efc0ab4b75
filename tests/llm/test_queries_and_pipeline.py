import os
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as entry_module
import compare
import corpus_pipeline
from conftest import DATA
from corpora import WORD, frame, words
from ledgerlake.llm.queries import ORACLE, QUERIES, pack_tokenizer
from ledgerlake.llm.storage import written

SF = os.path.join(DATA, "sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_registered():
    names = entry_module.queries()
    assert all(sum(name.startswith(f"op{n}_") for name in names) == 1 for n in range(1, 14)) and "pipeline" in names


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, name):
    assert compare.difference(QUERIES[name](spark, SF), compare.connect(SF), ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_one_row_per_document(spark, name):
    table, key = ("pages", "page_id") if name.startswith("op12_") else ("documents", "doc_id")
    docs = spark.read.parquet(f"{SF}/{table}.parquet")
    ids = Counter(r[key] for r in QUERIES[name](spark, SF).select(key).distinct().collect())
    assert ids == Counter(r[key] for r in docs.select(key).collect())


def test_held_out_languages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op2_compression_language"](spark, SF).filter("held_out and lang_pred != 'und'").join(docs, "doc_id").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) >= 0.95


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "near_dedup", "source_mixing", "best_fit_packing"]
    given = {r["doc_id"]: r["text"] for r in docs.collect()}
    table = docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before, table = table, written(stage(spark, table, SF), "stage")
        if k < 4:
            assert table.columns == docs.columns
        rows = table.collect()
        if k == 0:
            verdicts = QUERIES["op10_quality_rules"](spark, SF).filter("kept").collect()
            assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in verdicts)
            assert all(r["text"] == given[r["doc_id"]] for r in rows)
        if k == 1:
            assert all(Counter(r["text"].split("\n")) <= Counter(given[r["doc_id"]].split("\n")) for r in rows)
        if k == 2:
            stay, had = Counter(tuple(r) for r in rows), Counter(tuple(r) for r in before.collect())
            assert stay <= had and len(stay) == len(rows) < len(before.collect()) + 1
        if k == 3:
            words_in = sum(len(WORD.findall(r["text"])) for r in before.collect())
            assert abs(sum(len(WORD.findall(r["text"])) for r in rows) - words_in) <= 20
        if k == 4:
            from tokenizers import Tokenizer

            encoder = Tokenizer.from_file(pack_tokenizer())
            texts = [r["text"] for r in before.collect()]
            assert sum(r["length"] for r in rows) == sum(len(e.ids) + 1 for e in encoder.encode_batch(texts, add_special_tokens=False))
            filled = Counter()
            for r in rows:
                filled[r["sequence_id"]] += r["length"]
            assert max(filled.values()) <= 4096 and len(filled) <= -(-sum(filled.values()) // 4096) + 1


def test_pipeline_over_odd_documents(spark, tmp_path):
    rows = [(i, " ".join(words(i, 60)), "en", "a", 1) for i in range(20)] + [(90, None), (91, ""), (92, " ".join(words(1, 60)))]
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in got} == set(range(20))
    frame(spark, []).write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
