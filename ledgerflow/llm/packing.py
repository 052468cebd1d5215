"""Packing of documents into training sequences by multiway differencing.

A document longer than a sequence fills whole sequences first.  What is left of every
document is cut into short pieces, the pieces are dealt into groups of bounded size, and
each group is partitioned into windows by Karmarkar-Karp differencing: partial partitions
are merged, those with the greatest imbalance first, the fullest window of one with the
emptiest of the other, until one partition of near-equal windows is left.  If its fullest
window exceeds the capacity, the group gets one window more.

Defined results: a null text is an empty one, whose only id is the end id; rows that
repeat are packed each; other columns are not looked at.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm.common import staged, table
from ledgerflow.llm.tokens import encoder, id_bytes

CAPACITY = 2048
PIECE = 256  # ids of a short piece; many pieces to a window make windows near-equal
GROUP_WINDOWS = 256  # windows of a group, on average
PIECE_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, piece long"


def differencing(lengths: np.ndarray, windows: int) -> list[list[int]]:
    """Items of each window: Karmarkar-Karp differencing of ``lengths`` into ``windows``."""
    order = np.argsort(-lengths, kind="stable")
    # a partial partition: sums less the least, greatest first, without zeros, and its lists
    heap = [(-int(lengths[k]), n, [int(lengths[k])], [[int(k)]]) for n, k in enumerate(order)]
    heapq.heapify(heap)
    made = len(heap)
    while len(heap) > 1:
        _, _, sums, lists = heapq.heappop(heap)
        _, _, others, more = heapq.heappop(heap)
        over = len(sums) + len(others) - windows
        if over <= 0:
            sums, lists = sums + others, lists + more
        else:
            # the emptiest of one meet the fullest of the other
            keep, rest = len(sums) - over, len(others) - over
            met = [a + b for a, b in zip(sums[keep:], reversed(others[rest:]))]
            joint = [a + b for a, b in zip(lists[keep:], reversed(more[rest:]))]
            sums, lists = sums[:keep] + met + others[:rest], lists[:keep] + joint + more[:rest]
        ranked = sorted(range(len(sums)), key=sums.__getitem__, reverse=True)
        least = sums[ranked[-1]] if len(sums) == windows else 0
        sums, lists = [sums[r] - least for r in ranked], [lists[r] for r in ranked]
        heapq.heappush(heap, (-sums[0] + (sums[-1] if len(sums) == windows else 0), made, sums, lists))
        made += 1
    return heap[0][3] if heap else []


def windows_of(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """The fewest near-equal windows, from the least possible number up, that all fit."""
    count = max(1, -(-int(lengths.sum()) // capacity))
    while True:
        found = differencing(lengths, count)
        if max(int(lengths[w].sum()) for w in found) <= capacity:
            return found
        count += 1


def pieces(
    documents: DataFrame, tokenizer_path: str, end_id: int, capacity: int = CAPACITY, piece: int = PIECE
) -> DataFrame:
    """Every document's pieces: whole sequences, then short pieces of the rest."""

    def cut(batches):
        encode, end = encoder(tokenizer_path).encode, id_bytes([end_id])
        number = TaskContext.get().partitionId() << 40
        names = [c.split()[0] for c in PIECE_SCHEMA.split(", ")]
        for batch in batches:
            out = [[] for _ in names]
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1).to_pylist())):
                ids += end
                size = len(ids) // 4
                starts = [*range(0, size - capacity + 1, capacity)]
                starts += range(len(starts) * capacity, size, piece)
                for begin, until in zip(starts, [*starts[1:], size]):
                    row = (doc_id, begin, until - begin, zlib.crc32(ids[4 * begin : 4 * until]), size, number)
                    number += 1
                    for column, value in zip(out, row):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=names)

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECE_SCHEMA)


def packed(
    documents: DataFrame,
    tokenizer_path: str,
    end_id: int,
    capacity: int = CAPACITY,
    piece: int = PIECE,
    group_windows: int = GROUP_WINDOWS,
) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    rows = staged(pieces(documents, tokenizer_path, end_id, capacity, piece), "packing-pieces")
    rest = rows.filter(F.col("length") < capacity)
    total = rest.agg(F.sum("length")).first()[0] or 0
    groups = max(1, round(total / (capacity * group_windows)))
    full = rows.filter(F.col("length") >= capacity).withColumn(
        "sequence_id", F.col("piece") + F.lit(1 << 60)).withColumn("offset", F.lit(0).cast("long"))

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("piece")
        lengths = table.column("length").to_numpy()
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        base = table.column("group")[0].as_py() << 24
        for number, window in enumerate(windows_of(lengths, capacity)):
            window = np.sort(window)
            sequence[window] = base + number
            offset[window] = np.cumsum(lengths[window]) - lengths[window]
        return table.drop_columns(["group"]).append_column("sequence_id", pa.array(sequence)).append_column(
            "offset", pa.array(offset))

    dealt = rest.withColumn("group", F.pmod(F.xxhash64("piece"), F.lit(groups)))
    windows = dealt.groupBy("group").applyInArrow(pack, f"{PIECE_SCHEMA}, sequence_id long, offset long")
    return full.unionByName(windows).drop("piece")


def op5_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 ids."""
    import public_tokenizers

    return packed(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=1)
