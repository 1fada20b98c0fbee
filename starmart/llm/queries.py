"""Registered queries of the text operators: each applies its operator whole."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table


def op1_shard_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import shard_by_bytes
    return shard_by_bytes(table(spark, sf_dir, "documents"))


def op2_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .minhash import link_documents
    return link_documents(table(spark, sf_dir, "documents"), k=3, num=85, den=100,
                          bands=36, rows=7)


def op3_host_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pages import main_text
    return main_text(table(spark, sf_dir, "pages"))


def op4_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import find_leaks
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_transcript_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .transcripts import parse_transcripts
    return parse_transcripts(table(spark, sf_dir, "conversations"))


def op6_ngram_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import score_documents
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop(
        "mean_ratio", "threshold")


def op7_rans_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .rans import round_trip
    return round_trip(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op8_centroid_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language import identify
    return identify(table(spark, sf_dir, "documents"))


def op9_pack_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack_binary
    from .tokens import LARGE_STORE
    return pack_binary(table(spark, sf_dir, "documents"), store=LARGE_STORE).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset")


def op10_clause_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import score_documents
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_run_length_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .repair import Repair, damaged
    return Repair(damaged(table(spark, sf_dir, "conversations")), "copies").digests()


def op12_spill_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .alignment import align_documents
    return align_documents(table(spark, sf_dir, "documents"))


def op13_shift_and_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .urls import filter_urls
    return filter_urls(table(spark, sf_dir, "pages")).select(
        "page_id", "host", "path", "rule", "verdict")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_shard_bytes": op1_shard_bytes,
        "op2_circulant_minhash": op2_circulant_minhash,
        "op3_host_suffix_array": op3_host_suffix_array,
        "op4_spaced_seeds": op4_spaced_seeds,
        "op5_transcript_hmm": op5_transcript_hmm,
        "op6_ngram_ratio": op6_ngram_ratio,
        "op7_rans_ids": op7_rans_ids,
        "op8_centroid_language": op8_centroid_language,
        "op9_pack_binary": op9_pack_binary,
        "op10_clause_grammar": op10_clause_grammar,
        "op11_run_length_repair": op11_run_length_repair,
        "op12_spill_alignment": op12_spill_alignment,
        "op13_shift_and_urls": op13_shift_and_urls,
    }
