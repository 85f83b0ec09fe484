"""Upsert by key as plain joins: later rows of a batch win, the batch wins over the table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def last_per_key(batch: DataFrame, keys: list[str], seq: str = "seq") -> DataFrame:
    """The last arrived row of each key, without ``seq``.

    An aggregate rather than a ranking window: copies of one key are reduced
    inside each task before the shuffle, so a hot key never forms one big group.
    """
    columns = [name for name in batch.columns if name != seq]
    last = F.max_by(F.struct(*columns), F.col(seq)).alias("_last")
    return batch.groupBy(*keys).agg(last).select("_last.*")


def upsert(
    existing: DataFrame, batch: DataFrame, keys: list[str], seq: str | None = "seq"
) -> DataFrame:
    """``existing`` with every row whose key occurs in ``batch`` replaced.

    Revisions overwrite all non-key columns, nulls included. ``seq=None`` states
    that the batch holds each key once; otherwise copies of a key are dropped inside
    the tasks before the join sees them. The join strategy is left to Catalyst: a
    batch read from files has a known size, so a small one is broadcast and the
    table is not shuffled.
    """
    arriving = batch.select(*keys) if seq is None else batch.select(*keys).distinct()
    kept = existing.join(arriving, keys, "left_anti")
    last = batch if seq is None else last_per_key(batch, keys, seq)
    return kept.unionByName(last)


def upsert_counts(
    existing: DataFrame, batch: DataFrame, keys: list[str], seq: str = "seq"
) -> DataFrame:
    """One row ``(inserted, updated)``: new keys, and every other row of the batch.

    A key that occurs twice in the batch is one insert and one update.
    """
    known = existing.select(*keys, F.lit(True).alias("_known"))
    distinct = batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    sides = distinct.join(known, keys, "left")
    inserted = F.count(F.when(F.col("_known").isNull(), F.lit(1)))
    return sides.agg(
        inserted.alias("inserted"),
        (F.coalesce(F.sum("_rows"), F.lit(0)) - inserted).alias("updated"),
    )


CHANGE, COPIES, BEFORE = "_change", "_copies", "_before"


def changes(existing: DataFrame, batch: DataFrame, keys: list[str], seq: str | None = "seq") -> DataFrame:
    """What a batch makes of a table: every row afterwards, with how it came about.

    One full outer join on the key gives ``_change`` (``inserted``, ``updated`` or ``unchanged``), ``_copies`` (rows of
    the batch with that key), ``_before`` (the row that was replaced, a struct) and the columns of ``existing``.
    Without ``_change`` and its companions it is :func:`upsert`'s result; its changed rows are a feed from which counts
    and derived tables follow. ``seq=None`` states that the batch holds each key once.
    """
    row = F.struct(*existing.columns)
    if seq is None:
        last = batch.select(*keys, row.alias("_after"), F.lit(1).cast("bigint").alias(COPIES))
    else:
        # As in last_per_key: copies of a key are reduced inside the tasks.
        last = batch.groupBy(*keys).agg(
            F.max_by(row, F.col(seq)).alias("_after"), F.count(F.lit(1)).alias(COPIES)
        )
    both = existing.select(*keys, row.alias("_held")).join(last, keys, "full_outer")
    change = "CASE WHEN _held IS NULL THEN 'inserted' WHEN _after IS NULL THEN 'unchanged' ELSE 'updated' END"
    return both.select(
        F.expr(change).alias(CHANGE),
        F.coalesce(COPIES, F.lit(0)).alias(COPIES),
        F.expr("CASE WHEN _after IS NOT NULL THEN _held END").alias(BEFORE),
        F.coalesce("_after", "_held").alias("_row"),
    ).select(CHANGE, COPIES, BEFORE, "_row.*")


def change_counts(feed: DataFrame) -> DataFrame:
    """One row ``(inserted, updated)`` of a feed, as :func:`upsert_counts`."""
    inserted = F.count_if(F.col(CHANGE) == "inserted")
    return feed.agg(inserted.alias("inserted"), (F.coalesce(F.sum(COPIES), F.lit(0)) - inserted).alias("updated"))
