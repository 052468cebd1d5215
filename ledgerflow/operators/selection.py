"""Which messages a run processes, and in which chunk.

A folder is read outward in both directions from the span it has already read:
forward past its high mark and backward below its low mark.  Everything here works
on narrow ``(source_folder_id, uid)`` rows; raw bytes are joined on at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.operators import intervals
from ledgerflow.operators.joins import lookup_join, salted_join

BATCH_SIZE = 1000
CHUNK_SIZE = 100
# One folder's uids are ranked in this many independent parts before the final rank.
RANK_PARTS = 64

NATURAL_KEY = ["source_id", "folder_name", "uid_validity"]
HIGH = "high_water_mark"
LOW = "low_water_mark"


def backfill_start(batch_size: int) -> Column:
    """First uid of the next backfill span: ``batch_size`` uids below the low mark, floor 1."""
    return F.greatest(F.lit(1).cast("bigint"), F.col(LOW) - batch_size)


def is_first_run() -> Column:
    return F.col(HIGH).isNull() & F.col(LOW).isNull()


def is_new() -> Column:
    """Strictly past the high mark, so an idle folder does not read its last message again."""
    return F.coalesce(F.col("uid") > F.col(HIGH), F.lit(False))


def is_backfill(batch_size: int) -> Column:
    """Within the span below the low mark.

    The span counts uids, not messages: where uids are sparse it holds fewer rows.
    """
    within = (
        (F.col(LOW) > 1)
        & (F.col("uid") >= backfill_start(batch_size))
        & (F.col("uid") <= F.col(LOW) - 1)
    )
    return F.coalesce(within, F.lit(False))


def with_state(messages: DataFrame, state: DataFrame) -> DataFrame:
    """Marks of its folder on every message; folders without state are left out."""
    marks = state.select("source_folder_id", HIGH, LOW)
    return salted_join(messages, marks, ["source_folder_id"], ["uid"])


def select_join(messages: DataFrame, state: DataFrame, batch_size: int = BATCH_SIZE) -> DataFrame:
    """Messages the marks of their folder let through, before the cap.

    New and historical messages form one set: the two ranges cannot overlap.
    """
    return (
        with_state(messages, state)
        .filter(is_first_run() | is_new() | is_backfill(batch_size))
        .withColumn("first_run", is_first_run())
    )


def forward_only(messages: DataFrame, state: DataFrame) -> DataFrame:
    """Messages past the high mark of their folder."""
    return with_state(messages, state).filter(is_new())


def backfill_only(messages: DataFrame, state: DataFrame, batch_size: int = BATCH_SIZE) -> DataFrame:
    """Messages within the next backfill span of their folder."""
    return with_state(messages, state).filter(is_backfill(batch_size))


def newest_per_folder(messages: DataFrame, n: int, parts: int = RANK_PARTS) -> DataFrame:
    """The ``n`` highest uids of each folder, with ``newest_rank`` from 1.

    The first rank runs per folder part and keeps ``n`` of each, so the second one
    sees at most ``parts * n`` rows of a folder however many messages it holds.
    Spark applies both limits before the shuffle as well.
    """
    part = Window.partitionBy("source_folder_id", "_part").orderBy(F.desc("uid"))
    whole = Window.partitionBy("source_folder_id").orderBy(F.desc("uid"))
    return (
        messages.withColumn("_part", F.pmod(F.col("uid"), F.lit(parts)).cast("int"))
        .withColumn("_rank", F.row_number().over(part))
        .filter(F.col("_rank") <= n)
        .drop("_part", "_rank")
        .withColumn("newest_rank", F.row_number().over(whole))
        .filter(F.col("newest_rank") <= n)
    )


def number_chunks(selected: DataFrame, chunk_size: int = CHUNK_SIZE) -> DataFrame:
    """Cut each folder's selected messages into chunks numbered from 1.

    A first run goes through its uids upward, a later run downward.  A folder holds
    at most one batch here.
    """
    folder = Window.partitionBy("source_folder_id").orderBy(F.desc("uid"))
    size = F.count(F.lit(1)).over(Window.partitionBy("source_folder_id"))
    rank = F.row_number().over(folder)
    position = F.when(F.col("first_run"), size - rank + 1).otherwise(rank)
    return (
        selected.withColumn("_position", position)
        .withColumn(
            "chunk_num",
            (F.floor((F.col("_position") - 1) / F.lit(chunk_size)) + 1).cast("int"),
        )
        .drop("_position")
    )


def number_chunks_uncapped(
    selected: DataFrame, chunk_size: int = CHUNK_SIZE, span: int = 4096
) -> DataFrame:
    """The same numbering where a folder may hold any number of messages.

    Messages are ranked within spans of ``span`` uids, which bounds every group, and
    a span's place in its folder comes from the spans' message counts.
    """
    spans = selected.withColumn("_span", F.floor(F.col("uid") / F.lit(span)))
    key = ["source_folder_id", "_span"]
    folder = Window.partitionBy("source_folder_id")
    above = folder.orderBy(F.desc("_span")).rowsBetween(Window.unboundedPreceding, -1)
    places = (
        spans.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            *key,
            F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_above"),
            F.sum("_n").over(folder).alias("_size"),
        )
    )
    inner = F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("uid")))
    rank = F.col("_above") + F.col("_inner")
    position = F.when(F.col("first_run"), F.col("_size") - rank + 1).otherwise(rank)
    return (
        spans.withColumn("_inner", inner)
        .join(places, key)
        .withColumn("chunk_num", (F.floor((position - 1) / F.lit(chunk_size)) + 1).cast("int"))
        .drop("_span", "_inner", "_above", "_size")
    )


def select_arrivals(
    arrivals: DataFrame, state: DataFrame, chunk_size: int = CHUNK_SIZE
) -> DataFrame:
    """Forward selection of messages that just arrived, all of them, in numbered chunks.

    A folder without marks takes everything, any other what lies past its high mark.
    """
    new = (
        with_state(arrivals, state)
        .filter(is_first_run() | is_new())
        .withColumn("first_run", is_first_run())
    )
    if "readable" in new.columns:
        new = new.filter("readable")
    return number_chunks_uncapped(new, chunk_size).select(
        "source_folder_id", "uid", "first_run", "chunk_num"
    )


def unread_arrivals(
    arrivals: DataFrame, marks: DataFrame, processed: DataFrame, chunk_size: int = CHUNK_SIZE
) -> DataFrame:
    """Everything that arrived and was not processed yet, in numbered chunks.

    ``processed`` holds the runs of uids that committed batches processed, ``marks`` the span
    that a folder had read before this ledger knew it.  Files do not come in the order of
    their uids, so a message below the high mark counts as any other; a folder without marks
    takes everything.  A message that arrives twice at once is taken once.
    """
    span = marks.select("source_folder_id", HIGH, LOW)
    new = (
        lookup_join(arrivals, span, ["source_folder_id"], how="left")
        .filter(~F.coalesce(F.col("uid").between(F.col(LOW), F.col(HIGH)), F.lit(False)))
        .withColumn("first_run", is_first_run())
    )
    if "readable" in new.columns:
        new = new.filter("readable")
    new = intervals.remaining(new.dropDuplicates(["source_folder_id", "uid"]), processed)
    return number_chunks_uncapped(new, chunk_size).select(
        "source_folder_id", "uid", "first_run", "chunk_num"
    )


def gap_messages(
    messages: DataFrame, state: DataFrame, before: DataFrame, processed: DataFrame
) -> DataFrame:
    """Messages between the marks of their folder that no committed batch processed.

    A run that found more new mail than it may read leaves such gaps, and so does a chunk
    that failed.  ``before`` holds the marks a folder had when it entered the ledger: what
    lies between those was read elsewhere.  A message that cannot be read is no gap.
    """
    earlier = before.select(
        "source_folder_id", F.col(HIGH).alias("_high"), F.col(LOW).alias("_low"))
    marks = state.join(earlier, "source_folder_id", "left")
    rows = messages.filter("readable") if "readable" in messages.columns else messages
    inside = salted_join(rows, marks, ["source_folder_id"], ["uid"]).filter(
        F.col("uid").between(F.col(LOW), F.col(HIGH))
        & ~F.coalesce(F.col("uid").between(F.col("_low"), F.col("_high")), F.lit(False))
    )
    return intervals.remaining(inside.select(*messages.columns, HIGH, LOW), processed).withColumn(
        "first_run", F.lit(False))


def select_batch(
    messages: DataFrame,
    state: DataFrame,
    batch_size: int = BATCH_SIZE,
    chunk_size: int = CHUNK_SIZE,
    gaps: DataFrame | None = None,
) -> DataFrame:
    """``(source_folder_id, uid, first_run, chunk_num)`` of everything the next run reads.

    ``messages`` needs ``source_folder_id`` and ``uid``; with a ``readable`` column,
    unreadable messages take a place in the batch but none in a chunk.  With more new
    messages than ``batch_size`` the newest win; the rest are among the ``gaps`` of later
    runs, which are taken by uid like any other message.
    """
    eligible = select_join(messages, state, batch_size)
    if gaps is not None:
        eligible = eligible.unionByName(gaps)
    chosen = newest_per_folder(eligible, batch_size)
    if "readable" in chosen.columns:
        chosen = chosen.filter("readable")
    return number_chunks(chosen, chunk_size).select(
        "source_folder_id", "uid", "first_run", "chunk_num"
    )


def fetch_selected(messages: DataFrame, selection: DataFrame) -> DataFrame:
    """Selected messages with their raw bytes.

    Messages that name their folder by its natural key are found by that; the selection
    then carries it next to the folder's id.
    """
    if "source_folder_id" in messages.columns:
        return messages.join(selection, ["source_folder_id", "uid"])
    return messages.join(selection, [*NATURAL_KEY, "uid"])
