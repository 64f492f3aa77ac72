"""The registered queries of this subpackage and, where SQL can say it, their SQL."""

import public_tokenizers
from pyspark.sql import functions as F

from ratelake.llm import (
    bpe, chat, licenses, mixing, neardup, negatives, private, quality_model, quality_rules, sharding, token_counts,
    topk, trie,
)
from ratelake.llm.runtime import table

QUERIES: dict = {}
ORACLES: dict = {}


def query(name, sql=None):
    def add(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


@query("op4_quality_rules")
def op4_quality_rules(spark, folder):
    return quality_rules.rate_documents(
        table(spark, folder, "documents"), quality_rules.trusted_from_labels(table(spark, folder, "labels")))


@query("op5_quality_classifier")
def op5_quality_classifier(spark, folder):
    return quality_model.score_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op3_minhash_near_dedup")
def op3_minhash_near_dedup(spark, folder):
    return neardup.near_duplicates(table(spark, folder, "documents"))


@query("op1_mix_sources", mixing.MIX_SQL)
def op1_mix_sources(spark, folder):
    return mixing.mix(table(spark, folder, "documents"))


@query("op9_byte_level_bpe")
def op9_byte_level_bpe(spark, folder):
    return bpe.round_trip(table(spark, folder, "documents"),
                          public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op8_token_counts")
def op8_token_counts(spark, folder):
    return token_counts.count_tokens(
        table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


@query("op2_exact_top_k", topk.TOP_SQL)
def op2_exact_top_k(spark, folder):
    return topk.top_products(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


@query("op7_chat_formatting", chat.CHAT_SQL)
def op7_chat_formatting(spark, folder):
    given = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"))
    messages = given.unionByName(probe).withColumn("parts", chat.text_part())
    return chat.digests(chat.format_turns(messages))


@query("op6_license_scan")
def op6_license_scan(spark, folder):
    return licenses.scan_licenses(table(spark, folder, "documents"))


@query("op10_extendible_sharding")
def op10_extendible_sharding(spark, folder):
    return sharding.shard(table(spark, folder, "documents"))


@query("op11_hard_negatives", negatives.NEGATIVES_SQL)
def op11_hard_negatives(spark, folder):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, label)


@query("op12_prefix_trie", trie.TRIE_SQL)
def op12_prefix_trie(spark, folder):
    return trie.prefix_trie(table(spark, folder, "conversations"))


@query("op13_private_data")
def op13_private_data(spark, folder):
    return private.find_private(table(spark, folder, "documents"))
