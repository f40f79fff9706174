"""Registered queries of the operators, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, bloom_lm, bpe, chat, decontamination, embedding_dedup, hard_negatives, jaccard_join, oracle, pii, token_records, toxicity, url_rules, warc
from .tables import stored

Query = Callable[[SparkSession, str], DataFrame]

#: Id that ends a document in token files.
END_ID = 2
#: Host rules: host, path, action.
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]
#: A document counts as toxic from this score on.
TOXIC_FROM = 0.3


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fold(n: int) -> Column:
    """crc32 of ``doc_id`` as text, modulo ``n``; 0 for a NULL id."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n)), F.lit(0))


def vocabulary() -> bpe.Vocabulary:
    return bpe.Vocabulary.read(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.ToxicityModel:
    """A model that has not seen the labels of held-out rows."""
    return toxicity.fit(docs, labels.where(fold(4) != 2))


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = bloom_lm.score(read(spark, sf_dir, "documents"), train=fold(5) != 1)
    return scored.withColumn("held_out", fold(5) == 1).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), short_items=True)


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_components(read(spark, sf_dir, "documents"), width=3, percent=90)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity_model(docs, read(spark, sf_dir, "labels")))
    return scored.select("doc_id", (fold(4) == 2).alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, vocabulary()).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = warc.write_archives(read(spark, sf_dir, "pages"), min_bytes=0)
    return warc.read_archives(files).drop("url")


def op5_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        tokenizer = file.read()
    index = token_records.write_records(read(spark, sf_dir, "documents"), tokenizer, END_ID)
    return token_records.read_records(index).select("doc_id", "start", "n_tokens", "ids_crc32")


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.range(1).select(F.inline(F.array([F.struct(*(F.lit(v).alias(n) for n, v in zip(("host", "path", "action"), r, strict=True))) for r in URL_RULES])))
    return url_rules.judge(read(spark, sf_dir, "pages"), rules)


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(read(spark, sf_dir, "embeddings"), threshold=0.9)


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = "</s>[INST] ok [/INST]"
    more = spark.sql(f"select * from values (-7L, 0L, 'user', '{probe}'), (-7L, 1L, 'assistant', '{probe}') as t(conv_id, turn, role, text)")
    chats = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(more)
    examples = stored(chat.expand(chats), "chat_examples")
    turns = chat.turns_of(F.col("text"))
    whole = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    parsed = examples.select(
        "conv_id",
        "alone",
        F.when(F.col("last"), F.size(turns)).alias("n_turns"),
        F.when(F.col("last"), F.sha2(whole, 256)).alias("turns_sha256"),
        F.struct("example", chat.loss_text(F.col("text"), F.col("loss_start"), F.col("loss_chars")).alias("loss")).alias("part"),
        F.length("text").alias("chars"),
    )
    loss = F.array_join(F.transform(F.array_sort(F.collect_list("part")), lambda p: p["loss"]), "")
    return (
        parsed.groupBy("conv_id", "alone")
        .agg(F.max("n_turns").cast("long").alias("n_turns"), F.max("turns_sha256").alias("turns_sha256"), loss.alias("loss"), F.sum("chars").alias("formatted_chars"))
        .select("conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
    )


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        tokenizer = file.read()
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        model = file.read()
    return alignment.link_counts(read(spark, sf_dir, "documents"), tokenizer, model)


def _of_kind(kind: str) -> Callable[[Column], Column]:
    return lambda span: span["kind"] == kind


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.fit(pii.labelled_spans(pii.sample(docs))))
    base = F.filter("spans", lambda s: s["base"])
    counts = [F.size(F.filter(base, _of_kind(k))).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.written(base), 256).alias("base_sha256"), pii.written(F.col("spans")).alias("spans"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.quantised(read(spark, sf_dir, "embeddings"), 256.0, label)
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Query] = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_decontamination": op2_decontamination,
    "op3_warc": op3_warc,
    "op4_ngram_jaccard": op4_ngram_jaccard,
    "op5_token_records": op5_token_records,
    "op6_toxicity": op6_toxicity,
    "op7_url_filters": op7_url_filters,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_embedding_dedup": op9_embedding_dedup,
    "op10_chat_formatting": op10_chat_formatting,
    "op11_token_alignment": op11_token_alignment,
    "op12_pii": op12_pii,
    "op13_hard_negatives": op13_hard_negatives,
}

#: DuckDB statements, where SQL can express a query.
ORACLE: dict[str, str] = oracle.STATEMENTS
