"""Invoices and progress marks of a batch."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.operators.reconcile import assign_ids
from ledgerflow.operators.selection import backfill_only, backfill_start

CONFLICT_KEYS = ("invoice_number",)


def keyed(batch: DataFrame, position: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Add ``_alone``: a digest of the key, or of the row's place where the key has a NULL.

    A row with a NULL key conflicts with nothing.  Its place makes it a group of its
    own, so the many rows without a number do not meet in one task.  Both conflict
    steps group and join by key and ``_alone``, hence one shuffle serves both.
    """
    if "_alone" in batch.columns:
        return batch
    no_key = reduce(lambda a, b: a | b, [F.col(key).isNull() for key in keys])
    alone = F.when(no_key, F.xxhash64(*position)).otherwise(F.xxhash64(*keys))
    return batch.withColumn("_alone", alone)


def _first_wins(batch: DataFrame, position: Sequence[str], keys: Sequence[str]) -> DataFrame:
    order = Window.partitionBy(*keys, "_alone").orderBy(*position)
    return (
        keyed(batch, position, keys)
        .withColumn("_rank", F.row_number().over(order))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def _drop_conflicts(
    batch: DataFrame, existing: DataFrame, position: Sequence[str], keys: Sequence[str]
) -> DataFrame:
    taken = existing.select(*keys).dropna().withColumn("_alone", F.xxhash64(*keys))
    return keyed(batch, position, keys).join(taken, [*keys, "_alone"], "left_anti")


def first_wins(
    batch: DataFrame, position: Sequence[str], keys: Sequence[str] = CONFLICT_KEYS
) -> DataFrame:
    """Of rows with equal keys keep the first by ``position``; rows without a key all stay.

    ``position`` must be unique.  Spark cuts each key to one row per map task before
    the shuffle, so a number that a third of the rows carry costs no more than others.
    """
    return _first_wins(batch, position, keys).drop("_alone")


def drop_conflicts(
    batch: DataFrame,
    existing: DataFrame,
    position: Sequence[str],
    keys: Sequence[str] = CONFLICT_KEYS,
) -> DataFrame:
    """Rows whose key is not in the ledger yet; NULL keys never conflict."""
    return _drop_conflicts(batch, existing, position, keys).drop("_alone")


def new_rows(
    batch: DataFrame,
    existing: DataFrame,
    position: Sequence[str],
    keys: Sequence[str] = CONFLICT_KEYS,
) -> DataFrame:
    """The first row of each key that is not in the ledger yet, and all rows without a key."""
    return _drop_conflicts(
        _first_wins(batch, position, keys), existing, position, keys
    ).drop("_alone")


def insert_invoices(
    batch: DataFrame,
    existing: DataFrame,
    position: Sequence[str],
    keys: Sequence[str] = CONFLICT_KEYS,
    highest: int | None = None,
) -> DataFrame:
    """The rows of a batch that enter the ledger, with ids past its highest.

    Within the batch the first row of a key wins, then rows whose key is taken are
    skipped.  Keys are global: they conflict across users and vendors.  Pass other
    ``keys`` to narrow that.  With the ``highest`` id given, only the rows of ``existing``
    that share a key with the batch are needed.
    """
    if highest is not None:
        return assign_ids(new_rows(batch, existing, position, keys), list(position), F.lit(highest))
    highest = existing.agg(F.coalesce(F.max("id"), F.lit(0))).scalar()
    return assign_ids(new_rows(batch, existing, position, keys), list(position), highest)


def uid_bounds(messages: DataFrame, by: Sequence[str] = ("source_folder_id", "chunk_num")) -> DataFrame:
    """Highest and lowest uid per chunk, over all of its messages whatever became of them."""
    return messages.groupBy(*by).agg(
        F.max("uid").alias("max_uid"), F.min("uid").alias("min_uid")
    )


def merge_watermarks(state: DataFrame, bounds: DataFrame) -> DataFrame:
    """State of the folders a batch touched: marks only move outward, a NULL mark takes the new one."""
    touched = bounds.groupBy("source_folder_id").agg(
        F.max("max_uid").alias("max_uid"), F.min("min_uid").alias("min_uid")
    )
    marks = state.select("source_folder_id", "high_water_mark", "low_water_mark")
    return marks.join(touched, "source_folder_id").select(
        "source_folder_id",
        F.greatest("high_water_mark", "max_uid").alias("high_water_mark"),
        F.least("low_water_mark", "min_uid").alias("low_water_mark"),
    )


def next_state(state: DataFrame, marks: DataFrame) -> DataFrame:
    """State of all folders after a run: new marks where there are some."""
    new = marks.select(
        "source_folder_id",
        F.col("high_water_mark").alias("_high"),
        F.col("low_water_mark").alias("_low"),
    )
    return state.join(new, "source_folder_id", "left").select(
        "source_folder_id",
        F.coalesce("_high", "high_water_mark").alias("high_water_mark"),
        F.coalesce("_low", "low_water_mark").alias("low_water_mark"),
    )


def advance_empty_spans(state: DataFrame, messages: DataFrame, batch_size: int) -> DataFrame:
    """Marks for folders whose next backfill span holds no message.

    Without this such a folder stops reading backward.  The low mark moves to the
    start of the empty span, so the following run looks further down.  ``messages``
    are the folder's uids; only those in the span are looked at.
    """
    found = backfill_only(messages, state, batch_size).select("source_folder_id").distinct()
    return (
        state.filter(F.col("low_water_mark") > 1)
        .join(found, "source_folder_id", "left_anti")
        .select(
            "source_folder_id",
            "high_water_mark",
            backfill_start(batch_size).alias("low_water_mark"),
        )
    )


def update_watermarks(folders: DataFrame, updates: DataFrame, now: Column) -> DataFrame:
    """The folder table with new marks and times on the updated folders.

    ``now`` may be a column of ``updates``.
    """
    new = updates.select(
        F.col("source_folder_id").alias("id"),
        F.col("high_water_mark").alias("_high"),
        F.col("low_water_mark").alias("_low"),
        now.alias("_now"),
        F.lit(True).alias("_updated"),
    )
    hit = F.coalesce(F.col("_updated"), F.lit(False))

    def either(new_value: str, old: str) -> Column:
        return F.when(hit, F.col(new_value)).otherwise(F.col(old))

    return (
        folders.join(new, "id", "left")
        .withColumns({
            "high_water_mark": either("_high", "high_water_mark"),
            "low_water_mark": either("_low", "low_water_mark"),
            "last_processed_at": either("_now", "last_processed_at"),
            "updated_at": either("_now", "updated_at"),
        })
        .select(*folders.columns)
    )


def successful_chunks(rows: DataFrame, failures: DataFrame) -> DataFrame:
    """Rows of chunks that did not fail; a failed chunk leaves neither rows nor marks."""
    failed = failures.select("source_folder_id", "chunk_num").distinct()
    return rows.join(failed, ["source_folder_id", "chunk_num"], "left_anti")


def clear_table(table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Empty a table: ``(what is left, one row with the number of rows deleted)``."""
    return table.filter(F.lit(False)), affected_count(table, "deleted")


def affected_count(rows: DataFrame, name: str = "affected") -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias(name))
