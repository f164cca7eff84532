"""Registered queries of the training-data operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import alignment, factorization, hilbert, jaccard, langid, mixing, pii, quality, squares, template, warc
from .common import table


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"))


def op2_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.nearest(table(spark, sf_dir, "embeddings"))


def op3_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    return template.extract(table(spark, sf_dir, "pages"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_warc(spark, warc.write_warc(table(spark, sf_dir, "pages")))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:


    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_files import read_token_files, write_token_files

    return read_token_files(spark, write_token_files(table(spark, sf_dir, "documents")))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op11_pair_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"))


def op12_squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return squares.report(table(spark, sf_dir, "documents"))


def op13_factorization(spark: SparkSession, sf_dir: str) -> DataFrame:
    return factorization.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_hilbert": op2_hilbert,
    "op3_template": op3_template,
    "op4_warc": op4_warc,
    "op5_quality": op5_quality,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_language_id": op7_language_id,
    "op8_mixing": op8_mixing,
    "op9_token_files": op9_token_files,
    "op10_pii": op10_pii,
    "op11_pair_bitmaps": op11_pair_bitmaps,
    "op12_squares": op12_squares,
    "op13_factorization": op13_factorization,
}

ORACLE_SQL: dict[str, str] = {
    "op4_warc": warc.ORACLE,
    "op5_quality": quality.ORACLE,
    "op6_jaccard_join": jaccard.ORACLE,
    "op8_mixing": mixing.ORACLE,
}
