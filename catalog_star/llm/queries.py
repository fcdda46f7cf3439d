"""The operators of this package as queries over the driver's tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog_star.llm import embeddings, language, merkle, mixing, packing, quality, secrets, simhash, substrings, tokencounts, toxicity, turns, warc
from catalog_star.staging import stage, stage_path

QUERIES = {}
SQL: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


@query
def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    archive = stage_path(spark, "warc")
    warc.write_archives(table(spark, folder, "pages"), archive)
    found = warc.read_archives(spark, archive, with_payload=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL["op1_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, html, sha1(html) AS hex, max(page_id) OVER (PARTITION BY html) AS latest FROM p)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST((CAST('0x' || substr(hex, CAST(i // 4 * 5 + 1 AS INT), 5) AS BIGINT) >> CAST(15 - i % 4 * 5 AS INT)) & 31 AS INT) + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = latest THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> latest THEN latest END AS refers_to
FROM d
"""


@query
def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tokencounts.token_counts(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op3_compression_bands(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_rules(table(spark, folder, "documents"))


def in_fold(column: str, folds: int, fold: int):
    """Whether the CRC-32 of an id as text falls in a fold."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % folds == fold, F.lit(False))


@query
def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    learn = labels.where(~in_fold("doc_id", 5, 0))
    model = toxicity.fit(toxicity.draw_labelled(docs, learn, "doc_id", "text", "toxic", most_toxic=1500, most_ordinary=3000))
    scored = toxicity.score_texts(docs, model, {"doc_id": "doc_id"})
    return scored.select("doc_id", in_fold("doc_id", 5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op4_byte_cnn(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    learn = docs.where(~in_fold("doc_id", 3, 1))
    network = language.fit(language.draw_labelled(learn, "doc_id", "text", "lang", rows_per_language=400))
    found = language.identify(docs, network, {"doc_id": "doc_id"})
    return found.select("doc_id", in_fold("doc_id", 3, 1).alias("held_out"), "lang_pred", "score")


@query
def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, folder, "documents"))


@query
def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixture = mixing.mix_sources(table(spark, folder, "documents"))
    return mixing.taken_words(mixture).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


SQL["op5_mixing"] = mixing.comparison_sql("documents")


@query
def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op7_pivot_index(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, folder, "embeddings"))


@query
def op6_collinear_chains(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.repeated_passages(table(spark, folder, "documents")).drop("key")


@query
def op12_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2(secrets.written(F.col("base")), 256).alias("base_sha256"), secrets.written(F.col("spans")).alias("spans")
    )


SQL["op12_secrets"] = secrets.comparison_sql("documents")


@query
def op11_merkle(spark: SparkSession, folder: str) -> DataFrame:
    tampered = F.when(in_fold("doc_id", 2, 0), F.translate("text", "\n", "")).otherwise(F.col("text"))
    proofs = merkle.prove(table(spark, folder, "documents"), altered={"text": tampered})
    proofs = proofs.withColumn("folded", merkle.folded(F.col("claimed"), F.col("siblings")))
    way = F.array_join(F.transform("siblings", lambda s: merkle.written(F.concat(s["left"], s["right"]))), "")
    return proofs.select(
        "doc_id", *[merkle.written(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")], F.sha2(way, 256).alias("proof_sha256"),
        merkle.written(F.col("folded")).alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"),
    )


SQL["op11_merkle"] = merkle.comparison_sql("documents")


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with some rows dropped, emptied, cut short, repeated or given the wrong role, by the CRC-32 of conversation and turn."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(blank("text"), "[.!?]", "")).otherwise(blank("text"))
    role = F.when(kind == 4, "user").otherwise(blank("role"))
    copies = F.explode(F.sequence(F.lit(1), F.when(kind == 3, 2).otherwise(1)))
    return rows.where(kind != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


@query
def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations")
    fixed = turns.repair(damaged(rows))
    digests = stage(turns.line_digests(fixed.lines), "line_digests")
    report = stage(fixed.report, "report")
    found = rows.select(F.col("conv_id").alias("__id")).distinct()
    found = found.join(report, F.col("__id").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    found = found.join(digests, F.col("__id").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    zeros = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = F.sha2(F.lit(""), 256)
    return found.select(F.col("__id").alias("conv_id"), *zeros, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", empty).alias("repaired_sha256"))
