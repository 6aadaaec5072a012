"""A pipeline over the documents table: each stage is one operator, written and read again.

1. toxicity: documents that the segment model scores as toxic go;
2. near_duplicates: of each group of near-duplicates one row stays, of the smallest id;
3. repeats: passages that occur elsewhere are cut out of the texts;
4. personal_data: spans are replaced by their kind;
5. packing: what is left is cut into sequences along the curve.

Each stage sets the session as the library needs it (``tune``), also if it is run by itself.
All stages but the last keep the columns of documents; ``n_chars`` follows the text. Rows
with a null id stay unless a stage rejects them, and repeated rows are near-duplicates, told
apart by a number; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendmill.llm import curve, pii, segments, tensor_minhash, winnow
from lendmill.llm.common import table, written
from lendmill.session import tune

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _tuned(stage: Stage) -> Stage:
    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return stage(tune(spark), docs, sf_dir)

    return run


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


@_tuned
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return segments.clean_documents(docs, table(spark, sf_dir, "labels"))


@_tuned
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tensor_minhash.one_of_each(docs)


@_tuned
def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(winnow.without_repeats_in_place(docs))


@_tuned
def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(pii.mask(docs))


@_tuned
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return curve.piece_table(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("repeats", repeats),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: Tokenizer ids and a fitted classifier are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
