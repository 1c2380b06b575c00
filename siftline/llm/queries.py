"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from . import chat, decontaminate, language_id, line_dedup, quality, sentencepiece_bpe, sharding, simhash, url_filters, warc


def queries() -> dict[str, Callable]:
    return {
        "op1_quality_rules": quality.op1_quality_rules,
        "op2_chat_formatting": chat.op2_chat_formatting,
        "op3_simhash": simhash.op3_simhash,
        "op4_sharding": sharding.op4_sharding,
        "op5_line_dedup": line_dedup.op5_line_dedup,
        "op6_sentencepiece": sentencepiece_bpe.op6_sentencepiece,
        "op7_warc": warc.op7_warc,
        "op8_language_id": language_id.op8_language_id,
        "op9_decontaminate": decontaminate.op9_decontaminate,
        "op10_url_filters": url_filters.op10_url_filters,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_quality_rules": quality.oracle(), "op2_chat_formatting": chat.oracle(), "op7_warc": warc.oracle(), "op10_url_filters": url_filters.oracle()}
