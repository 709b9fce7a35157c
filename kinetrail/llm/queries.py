"""The registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinetrail.llm import byte_bpe, chat_format, decontaminate, license_scan, line_dedup, lm_scoring, minhash_dedup, quality_classifier, quality_rules, suffix_dedup
from kinetrail.shipping import ship


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents without lines on more than a tenth of their source's pages."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_dedup.drop_boilerplate(docs, ratio=0.1, min_pages=2)


OP1_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, source, text, coalesce(source, '') AS host FROM documents),
pages AS (SELECT host, count(*) AS pages FROM docs GROUP BY host),
split AS (SELECT rid, host, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM docs),
holding AS (SELECT host, line, count(DISTINCT rid) AS holding FROM split WHERE line <> '' GROUP BY host, line),
heavy AS (SELECT host, line FROM holding JOIN pages USING (host) WHERE holding >= 2 AND holding > 0.1 * pages),
marked AS (SELECT s.rid, s.line, s.i, h.line IS NULL AS stays FROM split s LEFT JOIN heavy h ON s.host = h.host AND s.line = h.line),
joined AS (SELECT rid, string_agg(line, chr(10) ORDER BY i) FILTER (WHERE stays) AS text, count(*) AS n_lines, count(*) FILTER (WHERE NOT stays) AS n_removed FROM marked GROUP BY rid)
SELECT d.doc_id, d.source, CASE WHEN d.text IS NOT NULL THEN coalesce(j.text, '') END AS text, coalesce(j.n_lines, 0) AS n_lines, coalesce(j.n_removed, 0) AS n_removed
FROM docs d LEFT JOIN joined j USING (rid)
"""


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one whose texts hold control strings, formatted and read back."""
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    turns = _table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), "role", "text")
    return chat_format.read_back(chat_format.build(turns.unionByName(extra)))


OP2_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
),
shown AS (
  SELECT *, replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[INST]', '&lsqb;INST]'), '[/INST]', '&lsqb;/INST]') AS r,
    replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[INST]', '&lsqb;INST]'), '[/INST]', '&lsqb;/INST]') AS t FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(length('<|turn|>' || r || '<|body|>' || t || '<|end|>'))::BIGINT AS formatted_chars, true AS positions_follow
FROM shown GROUP BY conv_id
"""


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts without the bytes that strings of 200 bytes repeat anywhere."""
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"), digests=True)


def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of each document among copies and near copies."""
    return minhash_dedup.classify(_table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "class_id")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repetition measures and the verdict on each document."""
    return quality_rules.assess(_table(spark, sf_dir, "documents").select("doc_id", "text"), keep=("doc_id",))


def _part(column: str, parts: int) -> F.Column:
    """crc32 of an integer id as text, modulo parts; ids that are null count as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a model of order 2, learned from six sevenths of them."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = lm_scoring.fit(docs, _part("doc_id", 7) != 2, order=2)
    scored = lm_scoring.score(docs, model, keep=("doc_id",))
    return scored.withColumn("held_out", _part("doc_id", 7) == 2)


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents, learned from the labels of four fifths."""
    docs, labels = _table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = quality_classifier.fit(docs, labels, _part("doc_id", 5) != 0)
    scored = quality_classifier.score(docs, model, keep=("doc_id",))
    return scored.select("doc_id", (_part("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents and the known texts as others spell them, under the ids -1, -2 and so on."""
    docs = _table(spark, sf_dir, "documents").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    others = spark.createDataFrame(_OTHERS, "doc_id bigint, text string")
    return license_scan.scan(docs.unionByName(others), license_scan.catalogue(spark)).select("doc_id", "canonical_sha256", "n_canonical_words", "license_id")


_OTHERS = [(-i, license_scan.other_spelling(text)) for i, (_, text) in enumerate(license_scan.KNOWN_TEXTS, 1)]


def _op8_sql() -> str:
    q = lambda x: "'" + x.replace("'", "''") + "'"
    known = ", ".join(f"({q(k)}, {q(text)})" for k, text in license_scan.KNOWN_TEXTS)
    others = ", ".join(f"({k}, {q(text)})" for k, text in _OTHERS)
    return f"""
WITH known(license_id, text) AS (VALUES {known}), others(doc_id, text) AS (VALUES {others}),
digests AS (SELECT sha256({license_scan.canonical_sql("text")}) AS canonical_sha256, min(license_id) AS license_id FROM known GROUP BY 1),
rows AS (SELECT doc_id, {license_scan.canonical_sql("text")} AS body FROM (SELECT doc_id::BIGINT AS doc_id, text FROM documents UNION ALL SELECT doc_id, text FROM others))
SELECT doc_id, sha256(body) AS canonical_sha256, CASE WHEN body = '' THEN 0 ELSE len(string_split(body, ' ')) END AS n_canonical_words, license_id
FROM rows LEFT JOIN digests ON sha256(body) = canonical_sha256
"""


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded bytes of all documents."""
    return byte_bpe.round_trip(_table(spark, sf_dir, "documents"), ("doc_id",))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, a row for each item."""
    docs, items = _table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark")
    return decontaminate.leaks(docs, items)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_chat_format": op2_chat_format,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_minhash_dedup": op4_minhash_dedup,
    "op5_quality_rules": op5_quality_rules,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_license_scan": op8_license_scan,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_decontamination": op10_decontamination,
}

ORACLE_SQL: dict[str, str] = {"op1_line_dedup": OP1_SQL, "op2_chat_format": OP2_SQL, "op8_license_scan": _op8_sql()}
