"""Registered queries of the operators over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lendmill.llm import chunks, crf, curve, lines, manifest, order_minhash, pii, quality, segments, tensor_minhash, trie, wavelet, winnow
from lendmill.llm.common import table

Run = Callable[[SparkSession, str], DataFrame]


def op1_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curve.piece_table(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op2_chunk_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_crf_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crf.extract(table(spark, sf_dir, "pages"))


def op4_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_wavelet_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.document_table(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op9_winnowed_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.kept_table(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(table(spark, sf_dir, "documents"))


def op6_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.span_table(table(spark, sf_dir, "documents"))


def op7_tensored_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tensor_minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.compare_edited(table(spark, sf_dir, "documents"))


def op12_common_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.kept_table(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.proofs(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.node_table(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Run] = {
    "op1_hilbert_packing": op1_hilbert_packing,
    "op2_chunk_reuse": op2_chunk_reuse,
    "op3_crf_main_text": op3_crf_main_text,
    "op4_toxic_segments": op4_toxic_segments,
    "op5_wavelet_shards": op5_wavelet_shards,
    "op6_pii_spans": op6_pii_spans,
    "op7_tensored_minhash": op7_tensored_minhash,
    "op8_order_minhash": op8_order_minhash,
    "op9_winnowed_repeats": op9_winnowed_repeats,
    "op10_quality_rules": op10_quality_rules,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_common_lines": op12_common_lines,
    "op13_merkle_manifest": op13_merkle_manifest,
}
SQL: dict[str, str] = {"op10_quality_rules": quality.sql(), "op12_common_lines": lines.sql()}
