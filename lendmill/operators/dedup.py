"""Deduplication and insert-if-absent.

Every operator here reduces copies on the map side before anything is shuffled, so a
key that holds a large share of all rows leaves each task as a single row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Key sets up to this many rows (UUID text: some 100 MB as a hash relation) may be
# broadcast; larger ones are left to a shuffled join.
MAX_BROADCAST_KEYS = 1_000_000


def first_by(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    copies: str | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The row of each key that comes first by ``order_by``.

    ``copies`` names a column that counts the rows of the key; it is exact also when
    tasks are run again, because it is part of the aggregate. ``columns`` are those of the
    result (all by default): the aggregate carries a row as one value, of which the optimizer
    leaves nothing out.
    """
    aggregates = [F.min_by(F.struct(*(columns or df.columns)), F.struct(*order_by)).alias("__row")]
    columns: list[Column | str] = ["__row.*"]
    if copies:
        aggregates.append(F.count(F.lit(1)).alias("__copies"))
        columns.append(F.col("__copies").alias(copies))
    return df.groupBy(*[F.col(k).alias(f"__key_{k}") for k in keys]).agg(*aggregates).select(*columns)


def existing_keys(target: DataFrame, batch_keys: DataFrame, keys: Sequence[str], batch_rows: int) -> DataFrame:
    """Keys of the batch that the target already holds.

    The target is reduced to its key columns and filtered by a semi join on the small
    batch, so a huge target is scanned but never shuffled.
    """
    wanted = batch_keys.select(*keys)
    if batch_rows <= MAX_BROADCAST_KEYS:
        wanted = F.broadcast(wanted)
    return target.select(*keys).join(wanted, list(keys), "left_semi")


def absent_rows(
    batch: DataFrame,
    target: DataFrame | None,
    unique_keys: Sequence[str],
    order_by: Sequence[str],
    batch_rows: int,
    distinct_in_batch: Sequence[str] = (),
) -> DataFrame:
    """Rows of the batch that an insert with *do nothing on conflict* would add.

    Each unique key is applied in turn: first the earliest row of the batch wins, then
    keys that the target holds are removed. Keys named in ``distinct_in_batch`` are
    known not to repeat inside the batch and need no shuffle for the first step.
    """
    rows = batch
    for key in unique_keys:
        if key not in distinct_in_batch:
            rows = first_by(rows, [key], order_by)
        if target is not None:
            rows = rows.join(existing_keys(target, batch, [key], batch_rows), [key], "left_anti")
    return rows.select(*batch.columns)


def first_arrival_within_watermark(stream: DataFrame, time_column: str, delay: str, key: str = "event_id") -> DataFrame:
    """Streaming dedup with bounded state: an id is remembered until the watermark passes."""
    return stream.withWatermark(time_column, delay).dropDuplicatesWithinWatermark([key])
