"""The registered queries ``opN_<name>``: each applies its operator to the whole intended table."""

from __future__ import annotations

from barlake.llm import bpe, jaccard_join, language_id, packing, quality_classifier, quality_rules, sharding, source_audit, span_dedup, suffix_dedup, token_store, topk_search, whitening
from barlake.llm.common import table


def op1_token_store(spark, sf_dir):
    return token_store.store_digest(table(spark, sf_dir, "documents"))


def op2_shard(spark, sf_dir):
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op3_pack(spark, sf_dir):
    return packing.pack_digest(table(spark, sf_dir, "documents"))


def op4_language(spark, sf_dir):
    return language_id.identify(table(spark, sf_dir, "documents"))


def op5_quality(spark, sf_dir):
    return quality_rules.judge_digest(table(spark, sf_dir, "documents"))


def op6_span_dedup(spark, sf_dir):
    return span_dedup.dedup_digest(table(spark, sf_dir, "documents"))


def op7_classify(spark, sf_dir):
    return quality_classifier.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_jaccard_join(spark, sf_dir):
    return jaccard_join.join_digest(table(spark, sf_dir, "documents"))


def op9_bpe(spark, sf_dir):
    return bpe.encode_digest(table(spark, sf_dir, "documents"))


def op10_topk(spark, sf_dir):
    return topk_search.search_embeddings(table(spark, sf_dir, "embeddings"))


def op11_whiten(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_source_audit(spark, sf_dir):
    return source_audit.audit(table(spark, sf_dir, "documents"))


def op13_suffix_dedup(spark, sf_dir):
    return suffix_dedup.dedup_digest(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_token_store, op2_shard, op3_pack, op4_language, op5_quality, op6_span_dedup, op7_classify, op8_jaccard_join, op9_bpe, op10_topk,
                                  op11_whiten, op12_source_audit, op13_suffix_dedup)}
