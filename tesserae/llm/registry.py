"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat, decontaminate, extract, lexical, mixing, negatives, pieces, pii, simhash, suffix, topk, toxicity, warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_topk": topk.op1_topk,
        "op2_revisits": warc.op2_revisits,
        "op3_main_text": extract.op3_main_text,
        "op4_pii": pii.op4_pii,
        "op5_chat": chat.op5_chat,
        "op6_simhash": simhash.op6_simhash,
        "op7_pieces": pieces.op7_pieces,
        "op8_decontaminate": decontaminate.op8_decontaminate,
        "op9_toxicity": toxicity.op9_toxicity,
        "op10_suffix_repeats": suffix.op10_suffix_repeats,
        "op11_lexical": lexical.op11_lexical,
        "op12_hard_negatives": negatives.op12_hard_negatives,
        "op13_mixing": mixing.op13_mixing,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_topk": topk.OP1_SQL,
        "op2_revisits": warc.OP2_SQL,
        "op5_chat": chat.OP5_SQL,
        "op8_decontaminate": decontaminate.OP8_SQL,
        "op10_suffix_repeats": suffix.OP10_SQL,
        "op11_lexical": lexical.OP11_SQL,
        "op12_hard_negatives": negatives.OP12_SQL,
    }
