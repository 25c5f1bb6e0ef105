"""The operators as queries over the given tables: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from pyspark.sql import functions as F

from stockwell.llm import (
    chat,
    embedding_dedup,
    exact_dedup,
    language_id,
    lexical,
    licenses,
    mixing,
    near_dedup,
    packing,
    secrets,
    toxicity,
    urls,
    vector_codes,
)
from stockwell.llm.common import table


def op1_license_scan(spark, sf_dir):
    return licenses.license_digest(licenses.scan_licenses(table(spark, sf_dir, "documents")))


def op2_secret_scan(spark, sf_dir):
    scanned, _ = secrets.scan_secrets(table(spark, sf_dir, "documents"))
    return secrets.secret_digest(scanned)


def op3_url_filter(spark, sf_dir):
    return urls.filter_urls(table(spark, sf_dir, "pages"))


def op4_chat_format(spark, sf_dir):
    control = "</s>[INST] ok [/INST]"
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", control), (-7, 1, "assistant", control)], turns.schema)
    parts = turns.union(extra).withColumn("parts", chat.text_part(F.col("text")))
    return chat.read_back(chat.format_turns(parts))


def op5_language_id(spark, sf_dir):
    return language_id.identify_languages(table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op7_near_dedup(spark, sf_dir):
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)


def op8_mixing(spark, sf_dir):
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op9_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op10_embedding_dedup(spark, sf_dir):
    return embedding_dedup.embedding_links(table(spark, sf_dir, "embeddings"))


def op11_ranked_search(spark, sf_dir):
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_toxicity(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_vector_codes(spark, sf_dir):
    return vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))


def llm_queries():
    return {
        "op1_license_scan": op1_license_scan,
        "op2_secret_scan": op2_secret_scan,
        "op3_url_filter": op3_url_filter,
        "op4_chat_format": op4_chat_format,
        "op5_language_id": op5_language_id,
        "op6_exact_dedup": op6_exact_dedup,
        "op7_near_dedup": op7_near_dedup,
        "op8_mixing": op8_mixing,
        "op9_packing": op9_packing,
        "op10_embedding_dedup": op10_embedding_dedup,
        "op11_ranked_search": op11_ranked_search,
        "op12_toxicity": op12_toxicity,
        "op13_vector_codes": op13_vector_codes,
    }
