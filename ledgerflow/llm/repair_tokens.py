"""Token ids in grammar-compressed blocks (Re-Pair).

Documents are dealt out by ranges of doc_id; a task writes its documents in order, in
blocks of about a million ids.  Within a block frequent pairs of neighbouring symbols are
replaced by new symbols, again and again, the most frequent first.  A block holds what is
left of the sequence, the rules (two symbols each) and for each rule the number of ids it
stands for, so that any range of ids is decoded without the rest of the block.

The blocks are rows of a Parquet table, written by Spark: a lost task leaves nothing
half-written.  Defined results: a null text is an empty one, whose only id is the end id;
null doc_ids come first; rows of equal doc_id are ordered by a hash of their texts; other
columns are not looked at.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import table
from ledgerflow.llm.tokens import encoder
from ledgerflow.session import new_run_dir

BLOCK_IDS = 1 << 20
HASH_BITS = 18
MIN_COUNT = 64  # a pair is frequent when it occurs so often in its block
ROUNDS = 8
BLOCK_SCHEMA = (
    "shard int, block int, start long, first_symbol int, doc_ids array<long>, "
    "lengths array<long>, symbols binary, rules binary, expansions binary"
)


def pair_rules(ids: np.ndarray, first_symbol: int, min_count: int = MIN_COUNT, rounds: int = ROUNDS):
    """(symbols, rules): the sequence with frequent pairs replaced, and the pairs.

    Symbol ``first_symbol + k`` stands for ``rules[k]``.  Every round counts the pairs of
    neighbours, through a table of hashed counts that passes over the rare ones, and
    replaces all that are at least a quarter as frequent as the most frequent one; where
    replacements overlap, the left one is made.  It ends when no pair is frequent.
    """
    symbols, rules, following = ids.astype(np.uint32), [], first_symbol
    for _ in range(rounds):
        if len(symbols) < 2:
            break
        left, right = symbols[:-1], symbols[1:]
        slot = (left * np.uint32(0x9E3779B1) ^ right * np.uint32(0x85EBCA77)) >> np.uint32(32 - HASH_BITS)
        counts = np.bincount(slot, minlength=1 << HASH_BITS)
        bar = max(min_count, int(counts.max()) // 4)
        if counts.max() < min_count:
            break
        places = np.flatnonzero((counts >= bar)[slot])
        keys = left[places].astype(np.uint64) << np.uint64(32) | right[places]
        pairs, which, times = np.unique(keys, return_inverse=True, return_counts=True)
        bar = max(min_count, int(times.max()) // 4)
        frequent = times >= bar
        if not frequent.any():
            break  # what seemed frequent were rare pairs that share a slot
        numbers = np.cumsum(frequent) - 1 + following
        chosen = frequent[which]
        places, names = places[chosen], numbers[which[chosen]]
        # of places in a row, every second one from the left
        fresh = np.ones(len(places), dtype=bool)
        fresh[1:] = np.diff(places) != 1
        run_start = np.maximum.accumulate(np.where(fresh, np.arange(len(places)), 0))
        taken = (np.arange(len(places)) - run_start) % 2 == 0
        places, names = places[taken], names[taken]
        symbols = symbols.copy()
        symbols[places] = names
        stays = np.ones(len(symbols), dtype=bool)
        stays[places + 1] = False
        symbols = symbols[stays]
        pairs = pairs[frequent]
        rules.append(np.stack([pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF)], axis=1).astype(np.uint32))
        following += len(pairs)
    return symbols, np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32)


def expansions(rules: np.ndarray, first_symbol: int) -> np.ndarray:
    """How many ids each rule stands for; a rule refers to earlier ones only."""
    out = np.ones(len(rules), dtype=np.uint32)
    for k, (left, right) in enumerate(rules.tolist()):
        out[k] = sum(1 if s < first_symbol else out[s - first_symbol] for s in (left, right))
    return out


def decode_range(symbols, rules, sizes, first_symbol: int, begin: int, end: int) -> np.ndarray:
    """Ids ``begin`` to ``end`` of a block; only the symbols over that range are expanded."""
    # all symbols' expansions one after the other: ids stand for themselves
    widths = np.concatenate([np.ones(first_symbol, np.int64), sizes.astype(np.int64)])
    starts = np.cumsum(widths) - widths
    flat = np.empty(first_symbol + int(sizes.sum()), dtype=np.uint32)
    flat[:first_symbol] = np.arange(first_symbol)
    for k, (left, right) in enumerate(rules.tolist()):
        at, middle = starts[first_symbol + k], widths[left]
        flat[at : at + middle] = flat[starts[left] : starts[left] + middle]
        flat[at + middle : at + middle + widths[right]] = flat[starts[right] : starts[right] + widths[right]]
    until = np.cumsum(widths[symbols])
    one, two = np.searchsorted(until, begin, side="right"), np.searchsorted(until, end, side="left") + 1
    part = symbols[one:two]
    before = int(until[one - 1]) if one else 0
    width = widths[part]
    place = np.repeat(starts[part] - (np.cumsum(width) - width), width)
    place += np.arange(len(place))
    return flat[place[begin - before : end - before]]


def grammar_blocks(
    documents: DataFrame, tokenizer_path: str, end_id: int, vocabulary: int, block_ids: int = BLOCK_IDS
) -> DataFrame:
    """The blocks of all documents, each task's in ascending doc_id order."""
    order = [F.col("doc_id").asc_nulls_first(), F.col("copy")]
    rows = documents.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("copy"))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")

    def blocks(batches):
        encode, shard = encoder(tokenizer_path).encode, TaskContext.get().partitionId()
        end = end_id.to_bytes(4, "little")
        held = {"doc_ids": [], "lengths": [], "bytes": []}
        number = start = size = 0

        def block():
            ids = np.frombuffer(b"".join(held["bytes"]), dtype=np.uint32)
            symbols, rules = pair_rules(ids, vocabulary)
            width = np.uint16 if vocabulary + len(rules) <= 1 << 16 else np.uint32
            return pa.RecordBatch.from_arrays([
                pa.array([shard], pa.int32()), pa.array([number], pa.int32()), pa.array([start], pa.int64()),
                pa.array([vocabulary], pa.int32()), pa.array([held["doc_ids"]], pa.list_(pa.int64())),
                pa.array([held["lengths"]], pa.list_(pa.int64())), pa.array([symbols.astype(width).tobytes()]),
                pa.array([rules.tobytes()]), pa.array([expansions(rules, vocabulary).tobytes()])],
                names=[c.split()[0] for c in BLOCK_SCHEMA.split(", ")])

        for batch in batches:
            encoded = encode(batch.column(1).to_pylist())
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoded):
                ids += end
                held["doc_ids"].append(doc_id)
                held["lengths"].append(len(ids) // 4)
                held["bytes"].append(ids)
                size += len(ids) // 4
                if size >= block_ids:
                    yield block()
                    number, start, size = number + 1, start + size, 0
                    for kept in held.values():
                        kept.clear()
        if held["doc_ids"]:
            yield block()

    return rows.mapInArrow(blocks, BLOCK_SCHEMA)


def opened(batch: pa.RecordBatch, row: int):
    """(symbols, rules, expansion lengths, first symbol) of one block."""
    value = lambda name, kind: np.frombuffer(batch.column(name)[row].as_buffer(), dtype=kind)
    first = batch.column("first_symbol")[row].as_py()
    rules, sizes = value("rules", np.uint32).reshape(-1, 2), value("expansions", np.uint32)
    width = np.uint16 if first + len(rules) <= 1 << 16 else np.uint32
    return value("symbols", width).astype(np.uint32), rules, sizes, first


def read_documents(blocks: DataFrame) -> DataFrame:
    """Per document of a block table: doc_id, start (ids of all documents before), ids."""
    shards = blocks.select("shard", F.col("start") + F.aggregate(
        "lengths", F.lit(0).cast("long"), lambda a, n: a + n), ).toDF("shard", "until").groupBy("shard").agg(
        F.max("until").alias("size"))
    # one row per shard, however many documents there are
    running = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("size").over(running), F.lit(0)).alias("before"))

    def read(batches):
        for batch in batches:
            for row in range(len(batch)):
                symbols, rules, sizes, first = opened(batch, row)
                lengths = np.array(batch.column("lengths")[row].as_py(), dtype=np.int64)
                ids = decode_range(symbols, rules, sizes, first, 0, int(lengths.sum()))
                until = np.cumsum(lengths)
                raw = ids.astype("<u4").tobytes()
                base = batch.column("before")[row].as_py() + batch.column("start")[row].as_py()
                begin = until - lengths
                for low in range(0, len(lengths), 512):
                    some = slice(low, low + 512)
                    yield pa.RecordBatch.from_arrays([
                        batch.column("doc_ids")[row].values[some], pa.array(base + begin[some]), pa.array(lengths[some]),
                        pa.array([raw[4 * b : 4 * e] for b, e in zip(begin[some].tolist(), until[some].tolist())], pa.binary())],
                        names=["doc_id", "start", "n_tokens", "ids"])

    return blocks.join(shards, "shard").mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def op1_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as ids in grammar blocks, written and read back."""
    import public_tokenizers

    path = new_run_dir(spark, "repair-blocks")
    blocks = grammar_blocks(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2, vocabulary=49408)
    blocks.write.option("compression", "zstd").parquet(path)
    read = read_documents(spark.read.schema(BLOCK_SCHEMA).parquet(path))
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def crc_of(ids) -> int:
    """The checksum the query returns, of any sequence of ids."""
    return zlib.crc32(np.asarray(ids, dtype="<u4").tobytes())
