"""Registered queries of this package: one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from vitrine.llm import (
    bpe, bytebpe, chat, lexical, linededup, mixing, pii, quality, secrets, simhash, spelling, topk, urls,
)
from vitrine.llm.oracles import ORACLES  # noqa: F401 - registered beside the queries

VOCABULARY = "word_bpe_49k.json"


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def byte_ranks() -> tuple[str, str]:
    """Rank file and splitting pattern of the byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    hexed = F.expr("lower(lpad(hex(fp), 16, '0'))")
    return simhash.simhash_classes(docs).select("doc_id", hexed.alias("fingerprint"), "component_id")


def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "source", "text")
    rows, plan = mixing.mixing_plan(docs)
    return mixing.realise(rows, plan).select(
        F.col("row.id").alias("doc_id"), "row.source", "row.tokens", "weight_ppm", "epoch", "position"
    )


def op3_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find_personal_data(_table(spark, folder, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.KINDS))
    of = lambda kind: F.filter("spans", lambda s: s["kind"] == kind)
    count = [F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select(
        "doc_id", *count, F.sha2(pii.spans_text(base), 256).alias("base_sha256"), pii.spans_text(F.col("spans")).alias("spans")
    )


def op4_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.find_secrets(_table(spark, folder, "documents").select("doc_id", "text"), keep=["doc_id"])
    count = {k: F.size(secrets.of_kinds(F.col("spans"), k)).cast("long") for k in ("assign", "access", "hex")}
    base = secrets.of_kinds(F.col("spans"), *count)
    return found.select(
        "doc_id",
        *[n.alias(f"n_{k}") for k, n in count.items()],
        F.sha2(secrets.spans_text(base), 256).alias("base_sha256"),
        secrets.spans_text(F.col("spans")).alias("spans"),
    )


def op5_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    coded = bpe.round_trip(docs, vocabulary_path(), keep=["doc_id"])
    return coded.select(
        "doc_id",
        F.expr("CAST(length(ids) / 4 AS BIGINT)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_chat(spark: SparkSession, folder: str) -> DataFrame:
    turns = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    own = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    return chat.conversation_digest(chat.prefix_examples(turns.union(own)))


URL_RULES = [
    urls.parse_rule("block", "net/"), urls.parse_rule("allow", "example.net/en/"),
    urls.parse_rule("block", "example.com/de/"), urls.parse_rule("allow", "org/fr/"),
]


def op7_urls(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages").select("page_id", "url", "html")
    # words of all page texts are the unigram table
    words = urls.word_table(pages.select(urls.page_text(F.col("html")).alias("shown")), "shown")
    judged = urls.judge(pages.select("page_id", "url"), URL_RULES, words)
    return judged.select("page_id", "host", "path", "rule", "verdict", F.round("score", 6).alias("score"))


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return quality.measure_quality(docs, keep=["doc_id"])


def op9_lines(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    done = linededup.drop_repeated_lines(docs, mark="n_deleted")
    return done.select(
        "doc_id", "n_deleted", F.length("text").cast("long").alias("chars_left"), F.sha2("text", 256).alias("text_sha256")
    )


def op10_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = topk.quantised(_table(spark, folder, "embeddings").select("vec_id", "embedding"))
    best = topk.top_k(vectors, vectors.filter("id % 20 = 0"), 20)
    return best.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op11_bytebpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    coded = bytebpe.round_trip(docs, *byte_ranks(), keep=["doc_id"])
    return coded.select(
        "doc_id",
        F.expr("CAST(length(ids) / 4 AS BIGINT)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_forms(_table(spark, folder, "documents").select("doc_id", "text"))


def op13_lexical(spark: SparkSession, folder: str) -> DataFrame:
    docs, items = _table(spark, folder, "documents"), _table(spark, folder, "benchmark")
    return lexical.search(docs.select("doc_id", "text"), items.select("item_id", "text"), 10)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_mixing": op2_mixing,
    "op3_pii": op3_pii,
    "op4_secrets": op4_secrets,
    "op5_bpe": op5_bpe,
    "op6_chat": op6_chat,
    "op7_urls": op7_urls,
    "op8_quality": op8_quality,
    "op9_lines": op9_lines,
    "op10_topk": op10_topk,
    "op11_bytebpe": op11_bytebpe,
    "op12_spelling": op12_spelling,
    "op13_lexical": op13_lexical,
}
