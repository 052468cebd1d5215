"""Marks and processed uids of folders as keyed state of a stream.

The second form of what the ledger keeps in buckets: state lives in Spark's state store, by folder
and block of 4096 spans of uids, as runs (``[first, last]``, ends included).  A folder whose uids
lie far apart is few entries, not one for every message; a block that comes to hold many runs is cut
into parts of 16 spans, so no entry grows beyond 32,768 runs.  Blocks are dealt into groups, for
Spark hands over to Python group by group and each costs more than its rows.  What comes out is by
folder and span.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from itertools import groupby

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ledgerflow.operators.intervals import KEY, SPAN, span_of

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
RUNS = "first array<bigint>, last array<bigint>"
OUTPUT = f"source_folder_id bigint, span bigint, {RUNS}, fresh bigint"
COLUMNS = ["source_folder_id", "span", "first", "last", "fresh"]
# an entry of the state: ``size`` spans of a folder, counted in that size
ENTRY = "source_folder_id bigint, size int, block bigint"
# spans that share an entry, runs beyond which it is cut up, and spans of the parts; a checkpoint
# keeps to one number of each, and of the groups
BLOCK = 4096
MOST_RUNS = 8192
PART = 16
GROUPS = 1024
# rows of a group that are held before equal ones are dropped, and rows that go out at a time
ROWS_HELD = 1_000_000
ROWS_OUT = 10_000


def merged_runs(first: list[int], last: list[int], uids: list[int]) -> tuple[list[int], list[int], int]:
    """Runs with more uids taken in, and how many of those were new."""
    runs = sorted([*zip(first, last), *((uid, uid) for uid in set(uids))])
    starts: list[int] = []
    ends: list[int] = []
    for begin, end in runs:
        if ends and begin <= ends[-1] + 1:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(begin)
            ends.append(end)
    held = sum(b - a + 1 for a, b in zip(first, last))
    return starts, ends, sum(b - a + 1 for a, b in zip(starts, ends)) - held


def within(first: list[int], last: list[int], block: int, size: int = 1) -> tuple[list[int], list[int]]:
    """The part of sorted runs that lies in one block of ``size`` spans."""
    low, high = block * size * SPAN, (block + 1) * size * SPAN - 1
    held = slice(bisect_left(last, low), bisect_right(first, high))
    return [max(uid, low) for uid in first[held]], [min(uid, high) for uid in last[held]]


def held(first: list[int], last: list[int]) -> int:
    """How many uids runs hold."""
    return sum(last) - sum(first) + len(first)


def in_order(frames: Iterable) -> tuple:
    """Folders and uids of a group's rows, each message once, by folder and uid."""
    import numpy as np

    def distinct(parts: list) -> tuple:
        folders, uids = (np.concatenate(column) for column in zip(*parts))
        order = np.lexsort((uids, folders))
        folders, uids = folders[order], uids[order]
        new = np.ones(len(uids), bool)
        new[1:] = (folders[1:] != folders[:-1]) | (uids[1:] != uids[:-1])
        return folders[new], uids[new]

    parts, pending = [], 0
    for frame in frames:
        parts.append((frame["source_folder_id"].to_numpy("int64"), frame["uid"].to_numpy("int64")))
        pending += len(frame)
        # mail that comes again and again is not all held
        if pending > max(ROWS_HELD, len(parts[0][0])):
            parts, pending = [distinct(parts)], 0
    return distinct(parts)


class UidRuns(StatefulProcessor):
    """Keeps the runs of a group's folders and blocks, and tells those of the spans that rows came for.

    A block that was cut up holds no runs itself; no other entry is without any.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.runs = handle.getMapState("runs", ENTRY, RUNS)

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        import numpy as np
        import pandas as pd

        self.empty = not self.runs.exists()
        folders, uids = in_order(rows)
        blocks = uids // (SPAN * BLOCK)
        ends = [*(np.flatnonzero((np.diff(folders) != 0) | (np.diff(blocks) != 0)) + 1).tolist(), len(uids)]
        out = []
        for start, end in zip([0, *ends], ends):
            folder = int(folders[start])
            for before, after, taken in self.taken_in(folder, int(blocks[start]), uids[start:end].tolist()):
                for span in sorted({uid // SPAN for uid in taken}):
                    found = within(*after, span)
                    out.append((folder, span, *found, held(*found) - held(*within(*before, span))))
            if len(out) >= ROWS_OUT:
                yield pd.DataFrame(out, columns=COLUMNS)
                out = []
        if out:
            yield pd.DataFrame(out, columns=COLUMNS)

    def taken_in(self, folder: int, block: int, uids: list[int]) -> Iterator[tuple]:
        """Take sorted uids of a block in; the runs before and after, and the uids, of each entry they are in."""
        whole = (folder, BLOCK, block)
        before = self.kept(whole)
        if before == ([], []):
            for part, mine in groupby(uids, key=lambda uid: uid // (SPAN * PART)):
                entry, mine = (folder, PART, part), list(mine)
                before = self.kept(entry) or ([], [])
                first, last, fresh = merged_runs(*before, mine)
                if fresh:
                    self.runs.updateValue(entry, (first, last))
                yield before, (first, last), mine
            return
        before = before or ([], [])
        first, last, fresh = merged_runs(*before, uids)
        if len(first) > MOST_RUNS:
            self.cut_up(folder, (first, last))
            self.runs.updateValue(whole, ([], []))
        elif fresh:
            self.runs.updateValue(whole, (first, last))
        yield before, (first, last), uids

    def kept(self, entry: tuple) -> tuple[list[int], list[int]] | None:
        """The runs of an entry as they were before this epoch, in which each is looked up once."""
        found = None if self.empty else self.runs.getValue(entry)
        return None if found is None else (list(found[0]), list(found[1]))

    def cut_up(self, folder: int, runs: tuple[list[int], list[int]]) -> None:
        """Keep the runs of a block by part."""
        size = SPAN * PART
        parts = {part for a, b in zip(*runs) for part in range(a // size, b // size + 1)}
        for part in sorted(parts):
            self.runs.updateValue((folder, PART, part), within(*runs, part, PART))

    def close(self) -> None:
        """Nothing is held open."""


def uid_runs(arrivals: DataFrame) -> DataFrame:
    """A stream of ``(source_folder_id, uid)`` as the runs of each folder and span it touches.

    Rows without a folder or uid take no part; a uid that comes again changes nothing.
    """
    block = F.floor(span_of("uid") / BLOCK).cast("long")
    group = F.pmod(F.xxhash64("source_folder_id", block), F.lit(GROUPS))
    return (
        arrivals.filter("source_folder_id is not null and uid is not null")
        .select(group.alias("group"), "source_folder_id", "uid")
        .groupBy("group")
        .transformWithStateInPandas(UidRuns(), OUTPUT, outputMode="Update", timeMode="None")
    )


def keep_runs(arrivals: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Take in what a stream holds beyond its checkpoint; each epoch's changes are one folder.

    An epoch that runs again after a crash replaces its folder.  State needs the RocksDB
    store; the session's own setting is left as it was.
    """
    conf = arrivals.sparkSession.conf
    old = conf.get(PROVIDER)

    def write(changes: DataFrame, epoch: int) -> None:
        changes.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    conf.set(PROVIDER, ROCKS)
    try:
        return (
            uid_runs(arrivals).writeStream.foreachBatch(write).outputMode("update")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
    finally:
        conf.set(PROVIDER, old)


def runs(spark: SparkSession, path: str) -> DataFrame:
    """The last state of every folder and span, as the runs that ``operators.intervals`` takes.

    All epochs are read; each holds the folders and spans it touched.
    """
    rows = spark.read.schema(OUTPUT + ", epoch bigint").parquet(path)
    newest = F.max_by(F.struct("first", "last"), "epoch").alias("kept")
    pairs = F.inline(F.arrays_zip(F.col("kept.first").alias("low"), F.col("kept.last").alias("high")))
    return rows.groupBy(*KEY).agg(newest).select(*KEY, pairs)


def marks(spark: SparkSession, path: str) -> DataFrame:
    """High and low mark of every folder; ``intervals.holes`` of the runs is what lies open between."""
    return runs(spark, path).groupBy("source_folder_id").agg(
        F.max("high").alias("high_water_mark"), F.min("low").alias("low_water_mark"))
