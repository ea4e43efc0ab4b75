"""The registered queries of this package, each over the whole table it is meant for, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import content_sort, fill_middle, hard_negatives, language_id, line_dedup, lm_score, main_text, mixing, near_dup, packing, quality, suffix_dedup
from .storage import ship_code

PACK_TOKENIZER = "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_code(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pack_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(PACK_TOKENIZER)


def _fold(n: int):
    """The remainder of the id's checksum that splits the documents into folds."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n))


def op1_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.scored(_table(spark, sf_dir, "documents"), _fold(7) == 2)


def op2_compression_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = _fold(5) == 0
    found = language_id.identified(docs, language_id.fit_dictionaries(docs.where(~held_out | held_out.isNull())))
    return found.withColumn("held_out", F.coalesce(held_out, F.lit(False)))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), pack_tokenizer())


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_sizes(_table(spark, sf_dir, "documents"))


def op5_suffix_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(_table(spark, sf_dir, "documents")).drop("kept")


def op6_prob_min_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dup.near_classes(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "class_size", "kept")


def op7_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort.content_classes(_table(spark, sf_dir, "documents"), keep="max")


def op8_line_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.unit_dedup(_table(spark, sf_dir, "documents"))
    span = lambda x: F.concat(x["start"].cast("string"), F.lit("-"), x["end"].cast("string"))
    length = F.aggregate("removed", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return found.select(
        "doc_id", "n_units", "n_removed", length.alias("removed_bytes"),
        F.array_join(F.transform("removed", span), ",").alias("removed_spans"),
    )


def op9_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.window_dedup(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.quality_verdicts(docs, quality.fit_quality(docs, _table(spark, sf_dir, "labels")))


def op11_skip_list_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_middle.filled_in_middle(_table(spark, sf_dir, "documents"))
    back = fill_middle.restored(F.col("output"), F.col("form"))
    return found.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"),
    )


def op12_recurrent_labeller(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    found = main_text.main_text(pages, main_text.fit_labeller(pages))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op13_window_tree_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    id_, label = F.col("vec_id"), F.col("label").cast("long")
    mixed = F.when(id_ % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = hard_negatives.usable(_table(spark, sf_dir, "embeddings"), id_, mixed, F.col("embedding"))
    return hard_negatives.hard_negatives(rows, id_ % 100 == 0)


QUERIES = {
    "op1_context_tree": op1_context_tree,
    "op2_compression_language": op2_compression_language,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_source_mixing": op4_source_mixing,
    "op5_suffix_merge": op5_suffix_merge,
    "op6_prob_min_hash": op6_prob_min_hash,
    "op7_content_sort": op7_content_sort,
    "op8_line_hashing": op8_line_hashing,
    "op9_line_windows": op9_line_windows,
    "op10_quality_rules": op10_quality_rules,
    "op11_skip_list_middle": op11_skip_list_middle,
    "op12_recurrent_labeller": op12_recurrent_labeller,
    "op13_window_tree_negatives": op13_window_tree_negatives,
}

_LINES = r"""
lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), places AS (
  SELECT *, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS words,
         sum(octet_length(encode(line)) + 1) OVER (PARTITION BY doc_id ORDER BY pos) - octet_length(encode(line)) - 1 AS start
  FROM lines
)"""

ORACLE = {
    "op7_content_sort": """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op8_line_hashing": rf"""
WITH {_LINES}, tokens AS (
  SELECT doc_id, pos, start + octet_length(encode(regexp_extract(line, '^[\x20\x09-\x0D]*'))) AS head,
         unnest(regexp_extract_all(line, '[^\x20\x09-\x0D]+[\x20\x09-\x0D]*')) AS token,
         generate_subscripts(regexp_extract_all(line, '[^\x20\x09-\x0D]+[\x20\x09-\x0D]*'), 1) AS k
  FROM places
), spoken AS (
  SELECT doc_id, pos, k, translate(regexp_extract(token, '^[^\x20\x09-\x0D]+'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS word,
         head + sum(octet_length(encode(token))) OVER line - octet_length(encode(token)) AS start
  FROM tokens WINDOW line AS (PARTITION BY doc_id, pos ORDER BY k)
), numbered AS (
  SELECT *, count(*) FILTER (word[-1] IN ('.', '!', '?')) OVER (PARTITION BY doc_id, pos ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS s
  FROM spoken
), sentences AS (
  SELECT doc_id, pos, s, min(start) AS start, count(*) AS n, string_agg(word, ' ' ORDER BY k) AS body FROM numbered GROUP BY doc_id, pos, s
), own AS (
  SELECT *, CASE WHEN n >= 5 THEN body WHEN n + lag(n) OVER line >= 5 THEN lag(body) OVER line || ' ' || body END AS unit,
         lead(start) OVER (PARTITION BY doc_id ORDER BY start) AS until
  FROM sentences WINDOW line AS (PARTITION BY doc_id, pos ORDER BY s)
), whole AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY string_agg(body, ' ' ORDER BY s) ORDER BY doc_id, pos) > 1 AS line_gone
  FROM sentences GROUP BY doc_id, pos
), judged AS (
  SELECT doc_id, start::BIGINT AS start, until::BIGINT AS until,
         line_gone OR (unit IS NOT NULL AND row_number() OVER (PARTITION BY unit ORDER BY doc_id, start) > 1) AS gone
  FROM own JOIN whole USING (doc_id, pos)
), spans AS (
  SELECT d.doc_id, j.start, coalesce(j.until, octet_length(encode(d.text))) AS until, coalesce(j.gone, false) AS gone
  FROM documents d LEFT JOIN judged j USING (doc_id)
)
SELECT doc_id, count(start) AS n_units, count(*) FILTER (gone) AS n_removed,
       coalesce(sum(until - start) FILTER (gone), 0)::BIGINT AS removed_bytes,
       coalesce(string_agg(start || '-' || until, ',' ORDER BY start) FILTER (gone), '') AS removed_spans
FROM spans GROUP BY doc_id""",
    "op9_line_windows": rf"""
WITH {_LINES}, filled AS (
  SELECT doc_id, pos, array_to_string(words, ' ') AS one,
         lead(array_to_string(words, ' '), 1) OVER doc AS two, lead(array_to_string(words, ' '), 2) OVER doc AS three,
         lead(pos, 2) OVER doc AS until
  FROM places WHERE len(words) > 0 WINDOW doc AS (PARTITION BY doc_id ORDER BY pos)
), repeats AS (
  SELECT doc_id, pos, until FROM filled WHERE three IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY one, two, three ORDER BY doc_id, pos) > 1
), judged AS (
  SELECT p.doc_id, p.pos, p.line, coalesce(max(r.until) >= p.pos, false) AS gone
  FROM places p LEFT JOIN repeats r ON r.doc_id = p.doc_id AND r.pos <= p.pos AND r.until >= p.pos
  GROUP BY p.doc_id, p.pos, p.line
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id""",
    "op11_skip_list_middle": r"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS d,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS tokens
  FROM documents
), ranks AS (
  SELECT *, len(tokens) AS n, ('0x' || d[1:8])::BIGINT % (len(tokens) + 1) AS r1, ('0x' || d[9:16])::BIGINT % (len(tokens) + 1) AS r2,
         ('0x' || d[17:24])::BIGINT % 100 AS h3, ('0x' || d[25:32])::BIGINT % 100 AS h4
  FROM drawn
), parts AS (
  SELECT *, array_to_string(tokens[1:least(r1, r2)], '') AS prefix, array_to_string(tokens[least(r1, r2) + 1:greatest(r1, r2)], '') AS middle,
         array_to_string(tokens[greatest(r1, r2) + 1:], '') AS suffix,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 >= 50 THEN 'plain'
              WHEN h4 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM ranks
)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
              ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts""",
    "op13_window_tree_negatives": """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
         [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_inner_product(a.v, r.v)::BIGINT AS score
  FROM usable a JOIN usable r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id, row_number() OVER best AS rank, n.vec_id AS negative_id, positive_score, n.score AS negative_score
FROM positives p JOIN scored n
  ON p.anchor_id = n.anchor_id AND NOT n.same AND 30 * positive_score <= 100 * n.score AND 100 * n.score <= 90 * positive_score
WINDOW best AS (PARTITION BY p.anchor_id, positive_id ORDER BY n.score DESC, n.vec_id) QUALIFY rank <= 10""",
}
