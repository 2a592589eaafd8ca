"""Queries of the text operators, for ``__spark_entry__``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from trailgrain.llm import boilerplate, encoding, language, neardup, packing, pii, residue, tokenizer


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _garbled(spark: SparkSession, sf: str) -> DataFrame:
    known = encoding.contexts_of(language.labelled(_table(spark, sf, "documents")))
    return encoding.find_garbled(_table(spark, sf, "pages"), known=known or None)


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return _garbled(spark, sf).select("page_id", "field_name")


def p1_restored(spark: SparkSession, sf: str) -> DataFrame:
    return _garbled(spark, sf)


def _languages(spark: SparkSession, sf: str) -> DataFrame:
    return language.language_rows(_table(spark, sf, "pages"), _table(spark, sf, "leads"), _table(spark, sf, "documents"))


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return _languages(spark, sf).select("rec_kind", "rec_id", "lang")


def p2_languages(spark: SparkSession, sf: str) -> DataFrame:
    return _languages(spark, sf)


def p2_segments(spark: SparkSession, sf: str) -> DataFrame:
    return language.page_segments(_table(spark, sf, "pages"), _table(spark, sf, "documents"))


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return boilerplate.find_furniture(_table(spark, sf, "pages"))


def p3_main_content(spark: SparkSession, sf: str) -> DataFrame:
    return boilerplate.main_content(_table(spark, sf, "pages"))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return neardup.similar_pairs(_table(spark, sf, "pages"))


def p4_groups(spark: SparkSession, sf: str) -> DataFrame:
    return neardup.groups(_table(spark, sf, "pages"))


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return residue.find_residue(_table(spark, sf, "pages"))


def p8_ids(spark: SparkSession, sf: str) -> DataFrame:
    return tokenizer.encode_column(_table(spark, sf, "documents"))


def p9_containers(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack_texts(_table(spark, sf, "documents"))


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    return pii.find_pii(_table(spark, sf, "documents"))


def p10_redacted(spark: SparkSession, sf: str) -> DataFrame:
    return pii.redact(_table(spark, sf, "documents"))


def p10_surrogates(spark: SparkSession, sf: str) -> DataFrame:
    """With an example of a key; a real one belongs in the caller's secrets."""
    return pii.redact(_table(spark, sf, "documents"), secret="an example key")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p1_restored, p2_found, p2_languages, p2_segments, p3_found, p3_main_content, p4_found, p4_groups, p6_found, p8_ids, p9_containers, p10_found, p10_redacted, p10_surrogates)}


def oracle_sql() -> dict[str, str]:
    """None of these is expressible in SQL over whole tables; tests hold them against brute force."""
    return {}
