"""Registered queries of the operators, with their production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import (
    attention_lm,
    bin_slack,
    circulant_minhash,
    fill_middle,
    line_chunks,
    patched_blocks,
    prefix_chat,
    pu_quality,
    secret_ownership,
    shifted_qr,
    suffix_decon,
    target_llr,
    url_rules,
)
from tallyloom.llm.subwords import Subwords

#: Fixed rules of the URL query.
URL_RULES = [
    url_rules.Rule("net", "/", "block"),
    url_rules.Rule("example.net", "/en/", "allow"),
    url_rules.Rule("example.com", "/de/", "block"),
    url_rules.Rule("org", "/fr/", "allow"),
]
#: A conversation of the chat query that holds strings like those of templates.
_TRICKY = r"\### Assistant: </turn> ok"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def byte_subwords() -> Subwords:
    """The public byte-level vocabulary that the queries use."""
    import public_tokenizers

    return Subwords(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    deduped = line_chunks.dedup_passages(table(spark, folder, "documents"))
    return deduped.select("doc_id", "text", "n_removed_lines", "n_removed_words")


def quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    open_rows = pu_quality.fold("doc_id", 3) != 1
    trusted = table(spark, folder, "labels").where((F.col("quality") == 1) & open_rows)
    network = pu_quality.fit(documents.where(open_rows), trusted)
    scored = pu_quality.score(documents, network)
    return scored.select("doc_id", (pu_quality.fold("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    trusted = target_llr.trusted_texts(documents, table(spark, folder, "labels"))
    return target_llr.judge(documents, target_llr.fit(documents, trusted)).drop("text")


def packing(spark: SparkSession, folder: str) -> DataFrame:
    return bin_slack.pack(table(spark, folder, "documents"), byte_subwords())


def benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = suffix_decon.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.drop("longest", "spans")


def minhash(spark: SparkSession, folder: str) -> DataFrame:
    return circulant_minhash.near_duplicates(table(spark, folder, "documents"))


def lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    held_out = pu_quality.fold("doc_id", 5) == 1
    scored = attention_lm.score_corpus(documents, ~held_out, byte_subwords())
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    given = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.range(2).selectExpr(
        "-7L AS conv_id", "id AS turn", "if(id = 0, 'user', 'assistant') AS role").withColumn("text", F.lit(_TRICKY))
    nodes, paths = prefix_chat.prefix_tree(given.unionByName(tricky), byte_subwords())
    return prefix_chat.read_back(nodes, paths)


def secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_ownership.find_secrets(table(spark, folder, "documents"))


def url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_rules.judge(table(spark, folder, "pages"), URL_RULES)


def token_files(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return patched_blocks.token_files(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    turned = fill_middle.fill_in_middle(table(spark, folder, "documents"))
    return turned.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_middle.restored(), 256).alias("restored_sha256"))


def embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return shifted_qr.whiten(table(spark, folder, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_line_dedup": line_dedup,
        "op2_quality_classifier": quality_classifier,
        "op3_quality_rules": quality_rules,
        "op4_packing": packing,
        "op5_lm_scores": lm_scores,
        "op6_chat_formatting": chat_formatting,
        "op7_benchmark_decontamination": benchmark_decontamination,
        "op8_minhash_near_dedup": minhash,
        "op9_secret_scan": secret_scan,
        "op10_url_filter": url_filter,
        "op11_token_files": token_files,
        "op12_fill_in_middle": fill_in_middle,
        "op13_embedding_whitening": embedding_whitening,
    }
