"""Ingest as a stream: each micro-batch is one committed ledger batch."""

from __future__ import annotations

import threading
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerflow.operators import selection
from ledgerflow.operators.ledger import BatchId, Ledger
from ledgerflow.plans.run import Answerer, RunSizes, located_and_lost, process_messages
from ledgerflow.sources.messages import message_keys

START_SECONDS = 300


def utc_now() -> Column:
    """The present moment as one literal."""
    return F.lit(datetime.now(timezone.utc))


def ingest_arrivals(
    ledger: Ledger,
    batch_id: BatchId,
    arrivals: DataFrame,
    context: DataFrame,
    answer: Answerer,
    now: Column,
    sizes: RunSizes = RunSizes(),
) -> None:
    """Process the messages of one micro-batch that no committed batch has processed.

    Nothing is capped: the size of a micro-batch is set where the stream is read.  What
    counts is whether a message was processed, not where its uid lies: arrivals come in
    any order.  Only the span a folder had read before it entered this ledger is skipped.
    A message without folder or source is recorded as failed.
    """
    if ledger.is_committed(batch_id):
        return
    ledger.begin(batch_id)
    folders = ledger.read("source_folder")
    before = folders.select(
        F.col("id").alias("source_folder_id"), "high_water_mark", "low_water_mark")
    keys = message_keys(arrivals)
    chosen = ledger.hand_over(
        "selected",
        selection.unread_arrivals(keys, before, ledger.intervals(keys), sizes.chunk_size),
        batch_id,
    )
    expected = chosen.count()
    chosen, lost = located_and_lost(chosen, context, folders)
    process_messages(
        ledger, batch_id, chosen, lambda rows: selection.fetch_selected(arrivals, rows),
        ledger.state(), context, answer, now, sizes, lost=lost,
        expected=expected,
    )


def start_incremental(
    messages: DataFrame,
    ledger: Ledger,
    context: DataFrame,
    answer: Answerer,
    checkpoint: str,
    sizes: RunSizes = RunSizes(),
    now: Callable[[], Column] = utc_now,
) -> StreamingQuery:
    """Process whatever a message stream holds beyond its checkpoint, then stop.

    A batch is named by the stream's id, which its checkpoint keeps, and the epoch.  A
    micro-batch that runs again after a crash keeps its name: if it had been committed it
    is skipped, otherwise its leftovers are replaced.  Other streams and runs on the same
    ledger have names of their own.
    """
    named, name = threading.Event(), []

    def handle(arrivals: DataFrame, epoch: int) -> None:
        if not named.wait(START_SECONDS):
            raise TimeoutError("the stream was not started")
        ingest_arrivals(ledger, f"{name[0]}-{epoch}", arrivals, context, answer, now(), sizes)

    stream = (
        messages.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    name.append(str(stream.id))
    named.set()
    return stream
