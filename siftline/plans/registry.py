"""The user's extension point: named operators with parameters, put together as an ordered list."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import python_text as p
from ..functions import scalars as s
from ..operators import dedup, records
from ..operators import lines as w

OPERATORS: dict[str, Callable[..., DataFrame]] = {}


def operator(name: str):
    def add(f):
        OPERATORS[name] = f
        return f

    return add


def _text(df: DataFrame, column) -> DataFrame:
    return df.withColumn("text", column)


operator("fix_unicode_mapper")(lambda df, normalization="NFKC": _text(df, p.normal_form(F.col("text"), normalization)))
operator("chinese_convert_mapper")(lambda df, source="", target="": _text(df, F.translate("text", source, target)))
operator("whitespace_normalization_mapper")(lambda df: _text(df, records.unicode_spaces(F.col("text"))))
operator("replace_content_mapper")(lambda df, rules=records.WEB_RULES: _text(df, records.replace_all(F.col("text"), rules)))
operator("remove_repeat_sentences_mapper")(lambda df, min_length=20: _text(df, p.drop_repeated_sentences(F.col("text"), min_length)))
operator("text_length_filter")(lambda df, min_len=50, max_len=3_000_000: df.filter(F.length("text").between(min_len, max_len)))
operator("alphanumeric_filter")(lambda df, min_ratio=0.45: df.filter(records.ratio_of(F.col("text"), r"\p{L}\p{N}") >= min_ratio))
operator("special_characters_filter")(lambda df, max_ratio=0.75: df.filter(records.ratio_of(F.col("text"), r"\p{P}\p{S}\p{Z}\p{N}") <= max_ratio))
operator("character_repetition_filter")(lambda df, rep_len=10, max_ratio=0.5: df.filter(p.repeated_ngram_share(F.col("text"), rep_len) <= max_ratio))
operator("document_deduplicator")(lambda df, order="doc_id": dedup.exact_dedup(df, "text", order))
operator("document_line_deduplicator")(lambda df, above=100, order="doc_id": df.drop("text").join(dedup.drop_frequent_lines(df, order, "text", above), order))
operator("noise_line_mapper")(lambda df, terms=(), max_len=60: _text(df, w.remove_noise_lines(F.col("text"), list(terms), max_len)[0]))
operator("basic_clean_mapper")(lambda df: _text(df, s.clean_basic(F.col("text"))))


def build(process: list[dict | str], overrides: dict[str, dict] | None = None) -> Callable[[DataFrame], DataFrame]:
    """``process``: names, or {name: parameters}. ``overrides`` change parameters by name; an unknown name is an error."""
    steps = [(x, {}) if isinstance(x, str) else next(iter(x.items())) for x in process]
    unknown = {n for n, _ in steps} - set(OPERATORS) | set(overrides or {}) - {n for n, _ in steps}
    if unknown:
        raise ValueError(f"unknown operators: {sorted(unknown)}")

    def run(df: DataFrame) -> DataFrame:
        for name, parameters in steps:
            df = OPERATORS[name](df, **{**(parameters or {}), **(overrides or {}).get(name, {})})
        return df

    return run
