"""Queries of the llm operators over the driver's tables, and their SQL where SQL can express them."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import sql
from .common import read_documents, small_batches
from .exact_dedup import exact_duplicates
from .language_id import identify_documents
from .lexical_search import search
from .media import documents_as_media
from .mixing import mix_documents
from .ngram_join import jaccard_components
from .secrets import scan_secrets
from .passage_dedup import repeated_passages
from .periodic_runs import periodic_runs, summarise_runs
from .sentencepiece import sample_segmentations
from .sharding import shard_documents
from .suffix_dedup import remove_repeats
from .token_files import encode_and_read


def op1_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return documents_as_media(read_documents(spark, sf_dir))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return jaccard_components(read_documents(spark, sf_dir), 3, 90, 100).drop("class")


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return sample_segmentations(read_documents(spark, sf_dir))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(read_documents(spark, sf_dir))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_documents(read_documents(spark, sf_dir))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return identify_documents(read_documents(spark, sf_dir)).select("doc_id", "held_out", "lang_pred", "score", "accepted", "cross_entropy")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(read_documents(spark, sf_dir))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return repeated_passages(read_documents(spark, sf_dir))


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return remove_repeats(read_documents(spark, sf_dir))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(read_documents(spark, sf_dir))


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return encode_and_read(read_documents(spark, sf_dir))


def _planted_words(doc_id: int | None, text: bytes) -> list[bytes]:
    """The words of op12: in every tenth document, by a checksum of its id, the words from a place on repeat."""
    words, mark = text.split(), zlib.crc32(str(doc_id).encode())
    if mark % 10 or not words:
        return words
    n, mark = len(words), mark // 10
    a = mark % n
    p = 1 + (n - a) // (3 + mark % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return summarise_runs(periodic_runs(read_documents(spark, sf_dir), _planted_words))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return search(read_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_media_columns, op2_ngram_jaccard, op3_sentencepiece, op4_secret_scan, op5_mix_sources, op6_language_id, op7_exact_dedup, op8_substring_dedup, op9_suffix_array_dedup, op10_sharding, op11_token_files, op12_periodic_runs, op13_lexical_search)}


def oracle_sql() -> dict[str, str]:
    """SQL where it can express the result; the others (images, sampling, models, MinHash) are held
    against brute-force versions in tests/llm."""
    return {
        "op2_ngram_jaccard": sql.ngram_jaccard(),
        "op4_secret_scan": sql.secrets(),
        "op7_exact_dedup": sql.exact_dedup(),
        "op9_suffix_array_dedup": sql.repeated_bytes(),
        "op10_sharding": sql.sharding(),
        "op13_lexical_search": sql.lexical_search(),
    }
