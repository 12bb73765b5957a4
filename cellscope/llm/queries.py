"""The registered queries of the corpus operators: thin views of their results."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellscope.llm import (conversations, decontam, langid, line_dedup, merkle, mil_quality, near_dup, oracles, packing, rules, secret_scan,
                           shards, token_orc, warc)
from cellscope.llm.common import table


def op1_mil_quality(spark, sf_dir):
    return mil_quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_line_dedup(spark, sf_dir):
    return line_dedup.report(table(spark, sf_dir, "documents"))


def op3_secret_scan(spark, sf_dir):
    return secret_scan.train_and_scan(table(spark, sf_dir, "documents"))


def op4_decision_list(spark, sf_dir):
    return rules.screen(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


def op6_warc(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op7_token_orc(spark, sf_dir):
    return token_orc.round_trip(table(spark, sf_dir, "documents"))


def op8_spaced_seed_leaks(spark, sf_dir):
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_rank_order_langid(spark, sf_dir):
    return langid.train_and_identify(table(spark, sf_dir, "documents"))


def op10_setsketch_near_dup(spark, sf_dir):
    return near_dup.link(table(spark, sf_dir, "documents"))


def op11_prefix_shards(spark, sf_dir):
    return shards.report(table(spark, sf_dir, "documents"))


def op12_glr_conversations(spark, sf_dir):
    return conversations.report(table(spark, sf_dir, "conversations"))


def op13_merkle_manifest(spark, sf_dir):
    return merkle.report(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_mil_quality, op2_line_dedup, op3_secret_scan, op4_decision_list, op5_packing, op6_warc, op7_token_orc,
    op8_spaced_seed_leaks, op9_rank_order_langid, op10_setsketch_near_dup, op11_prefix_shards, op12_glr_conversations,
    op13_merkle_manifest)}

ORACLE_SQL = {"op2_line_dedup": line_dedup.ORACLE_SQL, "op8_spaced_seed_leaks": decontam.ORACLE_SQL,
              "op11_prefix_shards": oracles.SHARDS, "op12_glr_conversations": oracles.CONVERSATIONS, "op13_merkle_manifest": oracles.MERKLE}
