"""The registered queries of this package, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat,
    decontaminate,
    exact_dedup,
    fim,
    hard_negatives,
    langid,
    line_dedup,
    ngram_lm,
    packing,
    secret_scan,
    simhash,
    token_store,
    toxicity,
)
from .shared import materialize, scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(docs: DataFrame, parts: int) -> Column:
    """The fold of each document: ``crc32(doc_id as text) mod parts``."""
    return F.pmod(F.crc32(docs["doc_id"].cast("string").cast("binary")), F.lit(parts))


def language_model(docs: DataFrame) -> langid.Model:
    """Learned from the labelled documents outside fold 1 of 3."""
    return langid.train(docs.where(fold(docs, 3) != 1).select("text", "lang"))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    docs = _table(spark, sf_dir, "documents")
    found = langid.identify(docs, language_model(docs)).withColumnRenamed("id", "doc_id")
    return found.select("doc_id", (fold(found, 3) == 1).alias("held_out"), "lang_pred", "score",
                        "entropy", "n_letters", "rejected")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the row of its text that stays."""
    return exact_dedup.mark(_table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its bin."""
    return packing.pack(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


#: The tables hold no labelled findings. These formats stand in for the issuers that would
#: confirm a finding (fixed values: what the test documents' secrets look like).
CONFIRMED = r"^AKIA[0-9A-Z]{16}$"
CONFIRMED_VALUE = r"(?i)^[0-9a-f]{18,40}$"
CONFIRMED_BEFORE = r"(?i)(password=|token = \")$"
#: What is surely none: plain words and paths of them or numbers, unless assigned to
#: a name, and hashes that are called so. What is neither confirmed nor this has no label.
PLAIN = r"^(([A-Z]?[a-z]+|[A-Z]+)?([_+/-]+([A-Z]?[a-z]+|[A-Z]+|[0-9]{1,4})?)*|[0-9_+/-]+)$"
ASSIGNED = r"[=:]>?\s*[\"'`]?$"
HASH = r"^[0-9a-fA-F]{32,}$"
HASH_BEFORE = r"(?i)\b(commit|revision|sha-?[0-9]*|md5|checksum|digest)[\s=:]+[\"'`]?$"


def labelled_findings(findings: DataFrame) -> DataFrame:
    """Findings outside fold 1 of 3, with the stand-in label: 1, 0, or null where it can't tell."""
    secret = F.col("candidate").rlike(CONFIRMED) | (
        F.col("candidate").rlike(CONFIRMED_VALUE) & F.col("before").rlike(CONFIRMED_BEFORE))
    none = (F.col("candidate").rlike(PLAIN) & ~F.col("before").rlike(ASSIGNED)) | (
        F.col("candidate").rlike(HASH) & F.col("before").rlike(HASH_BEFORE))
    learned = findings.withColumnRenamed("id", "doc_id")
    return learned.where(fold(learned, 3) != 1).withColumnRenamed("doc_id", "id").withColumn(
        "label", F.when(secret, 1).when(none, 0))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate of every document with the forest's verdict; its text only as a digest."""
    docs = _table(spark, sf_dir, "documents")
    findings = secret_scan.candidates(docs)
    model = secret_scan.train(labelled_findings(findings), docs)
    judged = secret_scan.judge(findings, model).withColumnRenamed("id", "doc_id")
    return judged.select(
        "doc_id", "start", F.length("candidate").alias("n_chars"), F.left("candidate", F.lit(4)).alias("prefix"),
        F.sha2("candidate", 256).alias("candidate_sha256"), (fold(judged, 3) == 1).alias("held_out"),
        "probability", "is_secret")


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by the model of the documents outside fold 0 of 10."""
    docs = _table(spark, sf_dir, "documents")
    model = ngram_lm.train(docs.where(fold(docs, 10) != 0))
    found = ngram_lm.score(docs, model).withColumnRenamed("id", "doc_id")
    return found.select("doc_id", (fold(found, 10) == 0).alias("held_out"), "n_tokens", "n_known",
                        "train_tokens", "base_score", "score")


TOKENIZER = "word_bpe_49k.json"
END_ID = 1


def op6_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and written, then read back from the files."""
    path = scratch_path(spark, "tokens")
    token_store.write_tokens(_table(spark, sf_dir, "documents"), path,
                             public_tokenizers.path(TOKENIZER), END_ID)
    return token_store.read_tokens(spark.read.parquet(path)).select(
        F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32", "shard", "block", "block_start")


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint and near-duplicate component."""
    return simhash.mark(_table(spark, sf_dir, "documents"), shingle_words=3, max_bits=3).select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the runs of lines that an earlier place has, and which lines went."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    removed = F.coalesce(F.col("cleaned.removed"), F.array())
    lost = F.aggregate(removed, F.lit(0), lambda n, x: n + x["last_line"] - x["first_line"] + 1)
    return line_dedup.clean(docs).select(
        "doc_id", F.coalesce("cleaned.text", "text").alias("text"), removed.alias("removed"),
        F.size(F.split("text", "\n")).alias("n_lines"), lost.alias("n_removed"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that copies a benchmark item, with the item and the aligned words."""
    found = decontaminate.matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "item_id", "similarity", "score", "item_words",
                        "word_start", "word_end")


#: The text of conversation -1, which holds the template's own control strings.
CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations formatted, written, and read back into digests."""
    convs = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.range(2).select(
        F.lit(-1).alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_TEXT).alias("text"))
    examples = materialize(chat.format_examples(convs.unionByName(control)), "chat-examples")
    turns = F.transform(chat.read_turns(F.col("text")),
                        lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    read = examples.select(
        "conv_id", "example",
        F.when(F.col("is_last"), F.col("n_turns").cast("bigint")).alias("n_turns"),
        F.when(F.col("is_last"), F.sha2(F.array_join(turns, ""), 256)).alias("turns_sha256"),
        chat.read_loss(F.col("text"), F.col("loss_start"), F.col("loss_length")).alias("loss"),
        F.length("text").alias("chars"))
    replies = F.array_join(F.transform(F.sort_array(F.col("losses")), lambda x: x["loss"]), "")
    return (read.groupBy("conv_id")
            .agg(F.max("n_turns").alias("n_turns"), F.max("turns_sha256").alias("turns_sha256"),
                 F.collect_list(F.when(F.col("loss").isNotNull(), F.struct("example", "loss"))).alias("losses"),
                 F.sum("chars").alias("formatted_chars"))
            .select("conv_id", "n_turns", "turns_sha256",
                    F.length(replies).cast("bigint").alias("loss_chars"),
                    F.sha2(replies, 256).alias("loss_sha256"), "formatted_chars"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every anchor and positive, the hardest rows of other labels."""
    vectors = _table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.usable(vectors, "embedding").select(
        "vec_id", label.alias("label"), hard_negatives.quantised(F.col("embedding")).alias("vec"),
        (F.col("vec_id") % 100 == 0).alias("is_anchor"))
    return hard_negatives.mine(rows, "is_anchor")


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a fill-in-the-middle example, and the text that the example gives back."""
    made = fim.transform(_table(spark, sf_dir, "documents"))
    return made.select(
        F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fim.restored(made["output"], made["form"]), 256).alias("restored_sha256"))


#: Least score of a toxic document.
TOXIC = 0.3


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by a machine that learned from the labels outside fold 2 of 4."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.where(fold(labels, 4) != 2))
    found = toxicity.score(docs, model).withColumnRenamed("id", "doc_id")
    return found.select("doc_id", (fold(found, 4) == 2).alias("held_out"), "score",
                        (F.col("score") >= TOXIC).cast("int").alias("predicted"), "n_terms")


OP2_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

OP10_SQL = r"""
WITH turns AS (
  SELECT conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations
  UNION ALL
  SELECT -1, i, r, '<|im_end|><|im_start|>assistant ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(i, r)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k,
    count(*) OVER (PARTITION BY conv_id) AS n,
    length('<|im_start|>') + length('<|im_end|>') + 2
      + length(role) + length(role) - length(replace(role, '\', ''))
      + (length(role) - length(replace(role, '<|', ''))) // 2
      + length(text) + length(text) - length(replace(text, '\', ''))
      + (length(text) - length(replace(text, '<|', ''))) // 2 AS chars
  FROM turns
), ends AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY k) AS chars_so_far FROM placed
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars_so_far) FILTER (role = 'assistant' OR k = n) AS BIGINT) AS formatted_chars
FROM ends GROUP BY conv_id
"""

OP11_SQL = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vec
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    CAST(list_dot_product(a.vec, b.vec) AS BIGINT) AS score
  FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT * FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.other_id AS positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY n.score DESC, n.other_id) AS INTEGER) AS rank,
  n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY rank <= 5
"""

OP12_SQL = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
  FROM documents
), drawn AS (
  SELECT *, len(units) AS n,
    CAST('0x' || substr(h, 1, 8) AS UBIGINT) % (len(units) + 1) AS one,
    CAST('0x' || substr(h, 9, 8) AS UBIGINT) % (len(units) + 1) AS two,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
           OR CAST('0x' || substr(h, 17, 8) AS UBIGINT) % 100 >= 50 THEN 'plain'
         WHEN CAST('0x' || substr(h, 25, 8) AS UBIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM cut
), pieces AS (
  SELECT *, array_to_string(units[1:least(one, two)], '') AS prefix,
    array_to_string(units[least(one, two) + 1:greatest(one, two)], '') AS middle,
    array_to_string(units[greatest(one, two) + 1:n], '') AS suffix
  FROM drawn
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
         ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM pieces
"""

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_secret_scan": op4_secret_scan,
    "op5_lm_score": op5_lm_score,
    "op6_token_store": op6_token_store,
    "op7_simhash_dedup": op7_simhash_dedup,
    "op8_line_dedup": op8_line_dedup,
    "op9_decontaminate": op9_decontaminate,
    "op10_chat_format": op10_chat_format,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_toxicity": op13_toxicity,
}

_SQL: dict[str, str] = {
    "op2_exact_dedup": OP2_SQL,
    "op10_chat_format": OP10_SQL,
    "op11_hard_negatives": OP11_SQL,
    "op12_fill_in_middle": OP12_SQL,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
