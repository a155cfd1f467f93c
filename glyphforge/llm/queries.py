"""The registered queries of the training-data operators, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from glyphforge.llm import bpe, chat, embeddings, infill, lines, minhash, mixing, quality, rules, substrings, topk, urls, whitening


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_minhash_dedup": minhash.op1_minhash_dedup,
        "op2_line_dedup": lines.op2_line_dedup,
        "op3_substring_dedup": substrings.op3_substring_dedup,
        "op4_mixing": mixing.op4_mixing,
        "op5_quality": quality.op5_quality,
        "op6_embedding_dedup": embeddings.op6_embedding_dedup,
        "op7_topk": topk.op7_topk,
        "op8_url_filter": urls.op8_url_filter,
        "op9_chat_format": chat.op9_chat_format,
        "op10_bpe": bpe.op10_bpe,
        "op11_whitening": whitening.op11_whitening,
        "op12_quality_rules": rules.op12_quality_rules,
        "op13_fill_in_middle": infill.op13_fill_in_middle,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_minhash_dedup": minhash.OP1_SQL,
        "op3_substring_dedup": substrings.OP3_SQL,
        "op6_embedding_dedup": embeddings.OP6_SQL,
        "op7_topk": topk.OP7_SQL,
        "op8_url_filter": urls.OP8_SQL,
        "op9_chat_format": chat.OP9_SQL,
        "op12_quality_rules": rules.OP12_SQL,
        "op13_fill_in_middle": infill.OP13_SQL,
    }
