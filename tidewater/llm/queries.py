"""The registered queries of the corpus operators: whole tables, whole texts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import audit, dialogue, forest, language, lines, mixing, passages, sketches, token_counts, token_files, toxicity, transducer, vantage
from tidewater.llm.common import held_out
from tidewater.session import spread, table

Plan = Callable[[SparkSession, str], DataFrame]

PLANS: dict[str, Plan] = {}
TWINS: dict[str, str] = {}

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def query(fn: Plan) -> Plan:
    PLANS[fn.__name__] = fn
    return fn


@query
def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vantage.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


@query
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, manifest = token_files.write_token_files(table(spark, sf_dir, "documents"), BYTE_BPE)
    return token_files.read_token_files(folder, manifest, digest=True)


@query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", held_out("doc_id").alias("held_out"))
    model = language.fit_languages(docs.filter("not held_out and doc_id is not null"))
    rows = language.predict_languages(spread(docs.select("doc_id", "text", "held_out")), model)
    return rows.select("doc_id", "held_out", "lang_pred", "score")


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held_out("doc_id").alias("held_out"))
    bad = table(spark, sf_dir, "labels").filter("toxic in (0, 1)").select("doc_id", F.col("toxic").alias("bad")).distinct()
    lexicon = toxicity.fit_lexicon(docs.filter("not held_out").join(bad, "doc_id"))
    return toxicity.score_toxicity(spread(docs), lexicon).select("doc_id", "held_out", "score", "predicted")


@query
def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return transducer.encoded_digest(docs, PIECE_BPE).drop("text")


@query
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.strip_repeats(table(spark, sf_dir, "documents")).drop("rest")


@query
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query
def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = mixing.with_words(spread(table(spark, sf_dir, "documents").select("doc_id", "source", "text")))
    mix = mixing.mixed(docs.select("doc_id", "source", "size"))
    each = mix.withColumn("_nth", F.explode(F.sequence(F.lit(1), F.col("n_rows").cast("int"))))
    return each.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies", "source"
    )


@query
def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return token_counts.count_tokens(docs, WORD_BPE).drop("text")


@query
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


TWINS["op12_filter_audit"] = audit.AUDIT_SQL


@query
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return dialogue.repair_report(rows, dialogue.damaged(rows, "conv_id", "turn", "role", "text"))


TWINS["op13_conversation_repair"] = dialogue.REPAIR_SQL
