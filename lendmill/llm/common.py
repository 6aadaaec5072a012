"""Helpers that the operators share: tables, working folders, Python tasks, salted joins."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lendmill.session import work_dir

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
#: Rows of one key that a task of a salted join takes, on average.
ROWS_PER_SALT = 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and the text (null: empty) under fixed names; other columns are left out, so
    their names cannot clash."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def in_tasks(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """``mapInArrow`` whose workers find this package, wherever the driver was started."""
    context = df.sparkSession.sparkContext
    paths = context.environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        context.environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])
    return df.mapInArrow(function, schema)


def written(df: DataFrame, label: str) -> DataFrame:
    """The frame, written to the shared working folder and read back: a cut of the lineage
    that outlives executors and is not computed again."""
    spark = df.sparkSession
    path = work_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def salts(rows: Column | str) -> Column:
    """How many tasks share a key with so many rows."""
    return F.ceil(F.greatest(F.col(rows) if isinstance(rows, str) else rows, F.lit(1)) / ROWS_PER_SALT)


def salted(many: DataFrame, one: DataFrame, keys: Sequence[str], spread: Sequence[str], count: str) -> DataFrame:
    """Inner join of many rows with one row per key. Both sides carry ``count``, the number
    of rows of the key: rows of a hot key are dealt over several tasks by ``spread``, and
    the one row is repeated for each."""
    left = many.withColumn("__salt", F.pmod(F.xxhash64(*spread), salts(count)))
    right = one.select("*", F.explode(F.sequence(F.lit(0).cast("long"), salts(count) - 1)).alias("__salt")).drop(count)
    return left.join(right, [*keys, "__salt"]).drop("__salt")
