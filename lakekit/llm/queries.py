"""The registered queries of this package: thin contracts over the operators, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekit.llm import bpe, chat, decontaminate, fingerprints, html_text, langid, line_dedup, lm_score, packing, pii, repair, simhash, trie
from lakekit.session import stored


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")


def op1_byte_level_bpe(spark: SparkSession, folder: str, vocabulary: str | None = None) -> DataFrame:
    ranks = bpe.load_ranks(vocabulary or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    coded = bpe.encode(_read(spark, folder, "documents"), ranks, keep=["doc_id"], decoded=True)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.edited_neighbours(_read(spark, folder, "documents"))


def op3_language_identification(spark: SparkSession, folder: str) -> DataFrame:
    documents = _read(spark, folder, "documents").withColumn("held_out", F.crc32(F.col("doc_id").cast("string")) % 4 == 2)
    field = langid.learn(documents.where("NOT held_out"))
    found = langid.predict(documents.select("doc_id", "held_out", "text"), field, keep=["doc_id", "held_out"])
    return found.select("doc_id", F.coalesce("held_out", F.lit(False)).alias("held_out"), "lang_pred", "score", "n_words")


def op4_chat_formatting(spark: SparkSession, folder: str, vocabulary: str | None = None) -> DataFrame:
    probe = "\\### Assistant: </turn> ok"
    rows = _read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame([(-7, 0, "user", probe), (-7, 1, "assistant", probe)], rows.schema)
    done = chat.format_conversations(rows.unionByName(added), vocabulary or public_tokenizers.path("byte_bpe_50k.json"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return chat.read_back(done).select(
        "conv_id", "n_turns", F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))


def op5_simhash_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(_read(spark, folder, "documents"))


def op6_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    found = html_text.extract(_read(spark, folder, "pages"), keep=["page_id", "url"])
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    documents = _read(spark, folder, "documents").select("doc_id", "text")
    lines = F.size(F.split("text", "\n", -1))
    counted = documents.withColumn("n_lines", F.when(F.col("text").isNull(), 0).otherwise(lines).cast("long"))
    found = line_dedup.without_repeated_lines(counted, keep_empty=True)
    return found.select("doc_id", "n_lines", "n_removed", F.char_length("text").cast("long").alias("n_chars"),
                        F.sha2("text", 256).alias("text_sha256"))


def op8_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.find_contamination(_read(spark, folder, "documents"), _read(spark, folder, "benchmark"), keep=["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "longest_match", "longest_words",
                        "longest_item", "longest_start")


def op9_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find_personal_data(_read(spark, folder, "documents"), keep=["doc_id"])


def op10_language_model_scores(spark: SparkSession, folder: str) -> DataFrame:
    documents = _read(spark, folder, "documents")
    listed = lm_score.frequent_words(documents)
    return lm_score.score(documents, lm_score.train(documents, listed), listed, keep=["doc_id"])


def _damaged(conversations: DataFrame) -> DataFrame:
    """The contract's damage by a hash of each row's conversation and turn."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))) % 20
    rows = conversations.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), fault.alias("fault")).where("fault <> 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("fault") == 3, 2).otherwise(1)))
    rows = rows.select("conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       copies.alias("copy"))
    return rows.drop("copy")


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    given = _read(spark, folder, "conversations")
    rows = _damaged(given)
    found = stored(repair.audits(rows), "repair-audits")
    said = repair.digests(repair.repaired_turns(rows, found)).withColumnRenamed("conv_id", "said_id")
    known = given.select(F.col("conv_id").alias("id")).distinct()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return known.join(found, F.col("id").eqNullSafe(F.col("conv_id")), "left").join(said, F.col("id").eqNullSafe(F.col("said_id")), "left").select(
        F.col("id").alias("conv_id"), *(F.coalesce(c, F.lit(0)).alias(c) for c in counts), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op12_sequence_packing(spark: SparkSession, folder: str, vocabulary: str | None = None) -> DataFrame:
    packed = packing.pack(_read(spark, folder, "documents"), vocabulary or public_tokenizers.path("word_bpe_49k.json"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def _rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The contract's conversations (turns, members): the first h turns of conversation c - c % 5, then c's own after its first h."""
    own = turns.groupBy("conv_id").agg(F.count("*").alias("own"))
    head = F.crc32(F.col("conv_id").cast("string")) % 9
    wanted = own.select("conv_id", "own", (F.col("conv_id") - F.col("conv_id") % 5).alias("source"), head.alias("h"))
    lengths = own.select(F.col("conv_id").alias("source"), F.col("own").alias("there"))
    wanted = wanted.join(lengths, "source", "left").withColumn("taken", F.least("h", F.coalesce("there", F.lit(0))))
    wanted = stored(wanted.withColumn("length", F.col("taken") + F.greatest(F.lit(0), F.col("own") - F.col("h"))), "trie-members")
    first = turns.where("place <= 8 AND conv_id % 5 = 0").withColumnRenamed("conv_id", "source")
    given = wanted.select("conv_id", "source", "h").join(first, "source").where("place <= h").select("conv_id", "place", "token", "size")
    rest = turns.where(F.col("place") > head).join(wanted.select("conv_id", "h", "taken"), "conv_id").select(
        "conv_id", (F.col("place") - F.col("h") + F.col("taken")).alias("place"), "token", "size")
    return stored(given.unionByName(rest), "trie-rebuilt"), wanted.select("conv_id", "length")


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie.prefix_trie(*_rebuilt(stored(trie.numbered(_read(spark, folder, "conversations")), "trie-numbered")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_byte_level_bpe, op2_document_fingerprints, op3_language_identification, op4_chat_formatting, op5_simhash_near_duplicates,
        op6_html_extraction, op7_line_dedup, op8_benchmark_decontamination, op9_personal_data,
        op10_language_model_scores, op11_conversation_repair, op12_sequence_packing, op13_prefix_trie,
    )}


#: What the template of ``chat`` makes of the conversations and the probe, in another engine's functions.
_OP4_SQL = r"""
WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS alone FROM conversations
           UNION ALL SELECT -7, turn, role, '\### Assistant: </turn> ok', NULL FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(turn, role)),
     e AS (SELECT *, length(regexp_replace(role, '(\\|###|</turn>|:)', '\\\1', 'g')) + length(regexp_replace(text, '(\\|###|</turn>)', '\\\1', 'g')) + 14 AS chars FROM r),
     c AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS said,
                  coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '') AS loss, CAST(sum(chars) AS BIGINT) AS formatted_chars
           FROM e GROUP BY conv_id, alone)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM c
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_chat_formatting": _OP4_SQL}
