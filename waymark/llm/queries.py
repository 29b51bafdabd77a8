"""The registered queries of this subpackage, ``(spark, sf_dir) -> DataFrame``, and their DuckDB equivalents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm.ann import nearest
from waymark.llm.chat import format_chat, read_back
from waymark.llm.common import fold, table
from waymark.llm.decontaminate import with_matches
from waymark.llm.licenses import PHRASES, TEMPLATES, licenses
from waymark.llm.lines import dedup_lines
from waymark.llm.near import near_duplicates
from waymark.llm.packing import pack
from waymark.llm.pii import KINDS, fit_skip_chain, with_pii
from waymark.llm.pitman_yor import score_texts
from waymark.llm.quality import fit_quality, with_quality
from waymark.llm.spelling import spelling_variants, vocabulary
from waymark.llm.toxicity import fit_toxicity, with_toxicity
from waymark.llm.whitening import whiten


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learnt from labels outside fold 1 of 3."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels").where(fold("doc_id", 3) != 1))
    scored = with_toxicity(docs, model)
    return scored.select(
        "doc_id",
        (fold("doc_id", 3) == 1).alias("held_out"),
        F.col("toxicity.score").alias("score"),
        (F.col("toxicity.score") >= 0.7).cast("int").alias("predicted"),
        F.col("toxicity.spans").alias("spans"),
    )


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of each document."""
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without repeated lines."""
    return dedup_lines(table(spark, sf_dir, "documents"))


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of each vector whose id is divisible by 20."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, a row for each pair."""
    found = with_matches(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.inline("matches"))


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of all documents, learnt from those outside fold 2 of 7."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (fold("doc_id", 7) != 2).alias("learn"))
    return score_texts(docs).select("doc_id", (fold("doc_id", 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of all documents: counts and digest of the base spans, and all spans."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = with_pii(docs, fit_skip_chain(docs))

    def told(spans):
        order = F.transform(
            spans, lambda s: F.struct(s["start"], F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).alias("k"), s["end"], s["kind"])
        )
        return F.array_join(F.transform(F.sort_array(order), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("pii.base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count, KINDS),
        F.sha2(told(F.col("pii.base")), 256).alias("base_sha256"),
        told(F.concat("pii.base", "pii.added")).alias("spans"),
        F.size("pii.added").cast("long").alias("n_added"),
    )


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents, learnt from labels outside fold 0 of 5."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_quality(docs, table(spark, sf_dir, "labels").where(fold("doc_id", 5) != 0))
    scored = with_quality(docs, model)
    return scored.select(
        "doc_id",
        (fold("doc_id", 5) == 0).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= 0.3).cast("int").alias("predicted"),
    )


def op9_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 4096 tokens; a digest of each piece's ids."""
    pieces = pack(table(spark, sf_dir, "documents"))
    return pieces.withColumn("ids", F.crc32("ids")).withColumnRenamed("ids", "ids_crc32")


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, whose texts are control strings, as read back from their examples."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    return read_back(format_chat(turns.unionByName(extra)))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near words and the frequent form of all words of the documents."""
    return spelling_variants(vocabulary(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op12_whiten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors on the 32 leading components of their exact covariance."""
    return whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").try_cast("long"))


def op13_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and wordings of all documents."""
    return licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP10_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), told AS (
  SELECT *,
    length(text) + length(text) - length(replace(text, '\', ''))
      + length(regexp_replace(text, '<(/?s>|\|)', '<\\\1', 'g')) - length(text)
      + length(regexp_replace(text, '\[(/?INST\])', '[\\\1', 'g')) - length(text) AS body,
    length(role) + 13 AS frame,
    turn = max(turn) OVER (PARTITION BY conv_id) AS ends
  FROM rows
), summed AS (
  SELECT *, sum(body + frame) OVER (PARTITION BY conv_id ORDER BY turn) AS so_far FROM told
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(so_far) FILTER (role = 'assistant' OR ends) AS BIGINT) AS formatted_chars,
  count(*) FILTER (role = 'assistant' OR ends) AS n_examples
FROM summed GROUP BY conv_id
"""

def _op13_sql() -> str:
    """Phrases and wordings by joins on the words themselves: every pair of equal grams, their diagonals, runs of near diagonals."""
    rows = ", ".join(f"({i}, '{t.label}', '{t.text}', {t.k}, [{', '.join(repr(w) for w in t.telling)}]::VARCHAR[], {t.phrase})" for i, t in enumerate((*PHRASES, *TEMPLATES)))
    return rf"""
WITH template AS (
  SELECT *, string_split(said, ' ') AS w FROM (VALUES {rows}) v(template, label, said, k, telling, phrase)
), size AS (
  SELECT template, label, k, phrase, len(w) - k + 1 AS grams, CASE WHEN phrase THEN 0 ELSE least(3, len(w) - 2) END AS slack FROM template
), place AS (
  SELECT template, k, unnest(range(len(w) - k + 1)) AS p, w, telling FROM template
), gram AS (
  SELECT template, k, p, array_to_string(w[p + 1 : p + k], ' ') AS said,
    len(telling) = 0 OR list_has_any(w[p + 1 : p + k], telling) AS telling FROM place
), doc AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), word AS (
  SELECT r, unnest(range(len(w))) AS pos, unnest(w) AS x FROM doc
), run AS (
  SELECT r, pos, x || ' ' || lead(x) OVER o AS two, x || ' ' || lead(x) OVER o || ' ' || lead(x, 2) OVER o AS three
  FROM word WINDOW o AS (PARTITION BY r ORDER BY pos)
), hit AS (
  SELECT r, pos, template, p, telling FROM run JOIN gram ON k = 2 AND two = said
  UNION ALL SELECT r, pos, template, p, telling FROM run JOIN gram ON k = 3 AND three = said
), told AS (
  SELECT hit.*, size.* EXCLUDE (template), pos - p AS diagonal FROM hit JOIN size USING (template)
), marked AS (
  SELECT *, CASE WHEN diagonal - lag(diagonal) OVER o <= slack THEN 0 ELSE 1 END AS new FROM told
  WINDOW o AS (PARTITION BY r, template ORDER BY diagonal)
), chained AS (
  SELECT *, sum(new) OVER (PARTITION BY r, template ORDER BY diagonal RANGE UNBOUNDED PRECEDING) AS chain FROM marked
), span AS (
  SELECT r, template, label, phrase, grams, min(pos) AS start, max(pos) - min(pos) + 1 AS own, count(DISTINCT p) AS found, bool_or(telling) AS telling
  FROM chained GROUP BY r, template, label, phrase, grams, chain
), sound AS (
  SELECT *, 2 * found / (grams + own) AS dice FROM span
  WHERE CASE WHEN phrase THEN found = grams ELSE telling AND found / grams >= 0.6 AND 2 * found / (grams + own) >= 0.5 END
), summed AS (
  SELECT r, count(*) FILTER (phrase) AS n_base, min(start) FILTER (phrase) AS first_word, max(start) FILTER (phrase) AS last_word,
    array_to_string(list_sort(list(DISTINCT label) FILTER (phrase)), ',') AS base_labels,
    array_to_string(list_sort(list(DISTINCT label)), ',') AS labels, max(dice) AS score
  FROM sound GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM doc LEFT JOIN summed USING (r)
"""


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_near_dedup": op2_near_dedup,
    "op3_line_dedup": op3_line_dedup,
    "op4_nearest": op4_nearest,
    "op5_decontaminate": op5_decontaminate,
    "op6_lm_score": op6_lm_score,
    "op7_pii": op7_pii,
    "op8_quality": op8_quality,
    "op9_pack": op9_pack,
    "op10_chat_format": op10_chat_format,
    "op11_spelling": op11_spelling,
    "op12_whiten": op12_whiten,
    "op13_license": op13_license,
}
ORACLE_SQL = {"op10_chat_format": OP10_SQL, "op13_license": _op13_sql()}
