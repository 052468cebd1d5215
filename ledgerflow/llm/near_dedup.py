"""Near duplicates by HyperMinHash.

A document is the set of its distinct word shingles.  The hashes of a set are dealt into
buckets; a bucket keeps its least hash as a register of leading-zero count and mantissa
bits.  Documents with the same set fall into one class at once.  Classes that share a band
of registers are candidates; their Jaccard similarity is estimated from the registers,
less the share of registers expected to agree by chance, and those that may reach the
threshold are confirmed on their full sets.

Within a group that shares a band, everyone is compared with one member, the one that
shares most bands with others; in small groups everyone with everyone.  What is linked
already needs no more comparing.  The members of large groups that are not one component
by then are grouped anew, exactly, by their rarest shingles, of which similar sets must
share one; as long as such a group spans several components, more of its members are
compared with all others, those outside its largest component first and then no more.  So
no link between components is lost, and no group is paired off as a whole.

Defined results: null texts and texts without words have an empty set and are linked with
nothing; rows that repeat are one class; a null ``doc_id`` is linked as any other but never
names a component, and is not kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerflow.llm import words as W
from ledgerflow.llm.common import staged, table
from ledgerflow.llm.graph import components, merged

BUCKET_BITS = 7
MANTISSA_BITS = 24
BAND = 4
SMALL = 16  # groups of up to so many are compared throughout at once
LANES = 256  # members of a larger group that are compared with all others in one round
MARGIN = 6.0  # standard deviations that an estimate may fall short before it is dropped


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): the sorted distinct shingles of each text."""
    words = W.split_words(data, offsets, W.UNBLANK, lower=True)
    grams = W.gram_values(words.values, size) if len(words.values) else words.values
    sets, counts = [], []
    for begin, end in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if end - begin >= size:
            own = np.unique(grams[begin : end - size + 1])
        elif end > begin:
            own = W.gram_values(words.values[begin:end], end - begin)[:1]
        else:
            own = words.values[:0]
        sets.append(own)
        counts.append(len(own))
    return np.concatenate(sets), np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


def registers(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(texts, buckets) int32: leading zeros and mantissa of each bucket's least hash, or -1."""
    buckets, rest = 1 << BUCKET_BITS, 64 - BUCKET_BITS
    out = np.full((len(first) - 1, buckets), -1, dtype=np.int32)
    if not len(hashes):
        return out
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    bucket = (hashes >> np.uint64(rest)).astype(np.int64)
    lead = np.ones(len(hashes), dtype=bool)
    lead[1:] = (bucket[1:] != bucket[:-1]) | (text[1:] != text[:-1])
    low = hashes[lead] & np.uint64((1 << rest) - 1)
    # exact bit length: of the upper half if there is one, else of the lower
    upper, lower = (low >> np.uint64(32)).astype(np.float64), (low & np.uint64(0xFFFFFFFF)).astype(np.float64)
    length = np.where(upper > 0, 32 + np.frexp(upper)[1], np.frexp(lower)[1]).astype(np.int64)
    zeros = rest - length
    left = (low << (zeros + BUCKET_BITS).astype(np.uint64)) << np.uint64(1)  # bits after the leading one
    mantissa = (left >> np.uint64(64 - MANTISSA_BITS)).astype(np.int64)
    out[text[lead], bucket[lead]] = (np.minimum(zeros, 63) << MANTISSA_BITS | mantissa).astype(np.int32)
    return out


def chance(n: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Probability that registers of unrelated sets of ``n`` and ``k`` shingles agree."""
    total = np.zeros(len(n))
    for zeros in range(64 - BUCKET_BITS):
        # the least hash of a bucket has exactly so many leading zeros
        exact = [
            np.exp(-size / (1 << BUCKET_BITS) * 0.5 ** (zeros + 1)) - np.exp(-size / (1 << BUCKET_BITS) * 0.5**zeros)
            for size in (n, k)
        ]
        total += exact[0] * exact[1]
    return total * 0.5**MANTISSA_BITS


def estimate(left: np.ndarray, right: np.ndarray, n: np.ndarray, k: np.ndarray):
    """(similarity, buckets used): agreeing registers among those in use, less chance."""
    used = ((left >= 0) | (right >= 0)).sum(axis=1)
    share = ((left == right) & (left >= 0)).sum(axis=1) / np.maximum(used, 1)
    by_chance = chance(n.astype(float), k.astype(float))
    return (share - by_chance) / (1 - by_chance), used


def sketches(documents: DataFrame, size: int) -> DataFrame:
    """Per row: doc_id, a hash of the text, set size, two independent 64-bit values of the set, registers."""

    def sketch(batches):
        for batch in batches:
            for low, high, data, offsets in W.text_slices(batch.column(1)):
                hashes, first = shingle_sets(data, offsets, size)
                sums = []
                for salt in W.MIX:
                    run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(W.mix(hashes ^ np.uint64(salt)), dtype=np.uint64)])
                    sums.append((run[first[1:]] - run[first[:-1]]).view(np.int64))
                rows = registers(hashes, first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), batch.column(2).slice(low, high - low),
                     pa.array(np.diff(first)), *map(pa.array, sums),
                     pa.array([r.tobytes() for r in rows], pa.binary())],
                    names=["doc_id", "text_key", "n_shingles", "node", "check", "sketch"])

    return documents.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_key")).mapInArrow(
        sketch, "doc_id long, text_key long, n_shingles long, node long, check long, sketch binary")


def bands(nodes: DataFrame) -> DataFrame:
    """(band, node, n_shingles): one row per band of registers that is not wholly empty."""

    def cut(batches):
        count = (1 << BUCKET_BITS) // BAND
        for batch in batches:
            raw = np.frombuffer(b"".join(batch.column(2).to_pylist()), dtype=np.int32)
            rows = raw.reshape(len(batch), count, BAND)
            value = np.broadcast_to(np.arange(count, dtype=np.uint64), rows.shape[:2])
            for k in range(BAND):
                value = W.mix(value * np.uint64(W.BASE) + rows[:, :, k].astype(np.uint32).astype(np.uint64))
            some = (rows >= 0).any(axis=2)
            row, _ = np.nonzero(some)
            yield pa.RecordBatch.from_arrays(
                [pa.array(value[some].view(np.int64)), batch.column(0).take(pa.array(row)),
                 batch.column(1).take(pa.array(row))], names=["band", "node", "n_shingles"])

    return nodes.select("node", "n_shingles", "sketch").mapInArrow(cut, "band long, node long, n_shingles long")


def alike(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b) whose sizes and registers allow the threshold."""
    side = lambda name: nodes.select(
        F.col("node").alias(name), F.col("n_shingles").alias(f"n_{name}"), F.col("sketch").alias(f"s_{name}"))
    rows = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "s_a", "s_b")

    def keep(batches):
        for batch in batches:
            sides = [np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.int32).reshape(
                len(batch), -1) for c in ("s_a", "s_b")]
            sizes = [np.asarray(batch.column(c)) for c in ("n_a", "n_b")]
            similarity, used = estimate(*sides, *sizes)
            least = percent / 100
            slack = MARGIN * np.sqrt(least * (1 - least) / np.maximum(used, 1))
            yield batch.filter(pa.array(similarity >= least - slack)).select(["a", "b"])

    return rows.mapInArrow(keep, "a long, b long")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs whose full sets have 100 * intersection >= percent * union."""
    rows = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b").select("a", "b", "x", "y")

    def check(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    return rows.mapInArrow(check, "a long, b long")


def full_sets(documents: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(node, shingles) of the wanted (doc_id, text_key, node): sorted 64-bit hashes as bytes."""

    def sets(batches):
        for batch in batches:
            for low, high, data, offsets in W.text_slices(batch.column("text")):
                hashes, first = shingle_sets(data, offsets, size)
                run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(W.mix(hashes ^ np.uint64(W.MIX[0])), dtype=np.uint64)])
                node = (run[first[1:]] - run[first[:-1]]).view(np.int64)
                own = np.asarray(batch.column("node").slice(low, high - low))
                # rows of one doc_id may differ in text: only the one of that set counts
                at = np.flatnonzero(node == own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own[at]), pa.array([hashes[first[i] : first[i + 1]].tobytes() for i in at], pa.binary())],
                    names=["node", "shingles"])

    texts = documents.select(F.col("doc_id").cast("long").alias("id"), "text", F.xxhash64("text").alias("key"))
    # the hash of the text keeps null ids spread
    own_row = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("key") == F.col("text_key"))
    return texts.join(wanted, own_row).select("node", "text").mapInArrow(
        sets, "node long, shingles binary").dropDuplicates(["node"])


def possible(left: str, right: str, percent: int):
    """Whether the set sizes alone allow the threshold."""
    return F.least(left, right) * 100 >= F.greatest(left, right) * percent


def ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """(key, node, n_shingles, rank): the rarest shingles of each set, as many as must hold
    one that any set of the wanted similarity shares; ``rank`` counts from the rarest."""

    def spread(batches):
        for batch in batches:
            for node, shingles in zip(batch.column(0), batch.column(1)):
                values = np.frombuffer(shingles.as_buffer(), dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values), pa.array(np.full(len(values), node.as_py())), pa.array(np.full(len(values), len(values)))],
                    names=["key", "node", "n_shingles"])

    rows = staged(sets.select("node", "shingles").mapInArrow(
        spread, "key long, node long, n_shingles long"), "near-shingles")
    # shingles of one set alone come first in its order: they are counted, not ranked
    often = staged(rows.groupBy("key").agg(F.count("*").alias("sets")).filter("sets > 1"), "near-often")
    own = Window.partitionBy("node")
    n = F.col("n_shingles")
    rank = F.row_number().over(own.orderBy("sets", "key")) + n - F.count("*").over(own)
    kept = rows.join(often, "key").withColumn("rank", rank).filter(
        F.col("rank") <= n - F.ceil(n * percent / 100) + 1)
    return kept.select("key", "node", "n_shingles", "rank")


def enough_left(percent: int):
    """Whether two sets can still be alike if this is the rarest shingle they share.

    What they share from there on is bounded by what each has left after it.
    """
    most = F.least(F.col("n_shingles") - F.col("rank"), F.col("n_b") - F.col("rank_b")) + 1
    return most * (100 + percent) >= (F.col("n_shingles") + F.col("n_b")) * percent


def connected(documents: DataFrame, nodes: DataFrame, size: int, percent: int) -> DataFrame:
    """(node, component) of the classes that links connect with another one."""
    rows = staged(bands(nodes), "near-bands")
    groups = rows.groupBy("band").agg(F.count("*").alias("members")).filter("members > 1")
    members = staged(rows.join(staged(groups, "near-groups"), "band"), "near-members")
    weight = staged(
        members.groupBy("node").agg(F.sum(F.least("members", F.lit(10000))).alias("weight")), "near-weight")
    sets = staged(full_sets(documents, nodes.join(weight, "node").select("doc_id", "text_key", "node"), size), "near-sets")
    members = members.join(weight, "node")
    hub = staged(members.groupBy("band").agg(
        F.max(F.struct("weight", "node", "n_shingles")).alias("hub")).select("band", "hub.*"), "near-hubs")
    hub = hub.select("band", F.col("node").alias("b"), F.col("n_shingles").alias("n_b"))
    star = members.join(hub, "band").filter((F.col("node") != F.col("b")) & possible("n_shingles", "n_b", percent))
    few = members.filter(F.col("members") <= SMALL).select("band", "node", "n_shingles")
    other = few.select("band", F.col("node").alias("b"), F.col("n_shingles").alias("n_b"))
    throughout = few.join(other, "band").filter((F.col("node") < F.col("b")) & possible("n_shingles", "n_b", percent))
    pair = [F.col("node").alias("a"), "b"]
    pairs = ordered(star.select(*pair).unionByName(throughout.select(*pair)))
    found = staged(confirmed(alike(pairs, nodes, percent), sets, percent), "near-links")
    label = components(found)
    # classes in large groups that are not one component yet: exact candidates among them
    large = members.filter(F.col("members") > SMALL).join(label, "node", "left")
    split = large.groupBy("band").agg(
        F.min(F.coalesce("component", "node")).alias("least"), F.max(F.coalesce("component", "node")).alias("most")
    ).filter("least <> most")
    risky = staged(large.join(staged(split, "near-split"), "band").select("node").distinct(), "near-risky")
    if risky.isEmpty():
        return label
    # a round shuffles what it compares with, so it is given these classes alone
    nodes = staged(nodes.select("node", "n_shingles", "sketch").join(risky, "node"), "near-risky-nodes")
    sets = staged(sets.join(risky, "node"), "near-risky-sets")
    return compared(prefixes(sets, percent), label, nodes, sets, percent)


def compared(rows: DataFrame, label: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``label`` with further links, until no pair of a group (key, node) could add any.

    Per round, LANES members of each group that are not in the group's largest component
    are compared with all its members of other components.  They are done then; a group
    is done when the members that are left are in one component.
    """
    rows = staged(rows, "near-open")
    while True:
        rows = rows.join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))
        largest = rows.groupBy("key", "component").agg(F.count("*").alias("n")).groupBy("key").agg(
            F.count("*").alias("parts"), F.max(F.struct("n", "component")).alias("most")).filter("parts > 1")
        largest = staged(largest.select("key", F.col("most.component").alias("largest")), "near-largest")
        rows = staged(rows.join(largest, "key"), "near-open")
        if rows.isEmpty():
            return label
        lane = F.pmod(F.xxhash64("node"), F.lit(LANES))
        hubs = rows.filter("component <> largest").groupBy("key", lane.alias("lane")).agg(
            F.max(F.struct("node", "n_shingles", "component", "rank")).alias("hub"))
        hubs = staged(hubs.select("key", F.col("hub.node").alias("b"), F.col("hub.n_shingles").alias("n_b"),
                                  F.col("hub.component").alias("other"), F.col("hub.rank").alias("rank_b")), "near-hubs")
        more = rows.join(hubs, "key").filter(
            (F.col("component") != F.col("other")) & possible("n_shingles", "n_b", percent) & enough_left(percent))
        pairs = ordered(more.select(F.col("node").alias("a"), "b"))
        fresh = staged(confirmed(alike(pairs, nodes, percent), sets, percent), "near-fresh")
        if not fresh.isEmpty():
            label = merged(label, fresh)
        rows = rows.join(hubs.select("key", F.col("b").alias("node")), ["key", "node"], "left_anti").select(
            "key", "node", "n_shingles", "rank")


def near_duplicates(documents: DataFrame, size: int = 5, percent: int = 80, keyed: bool = False) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (least doc_id reachable), kept.

    ``keyed`` adds text_key, the xxhash64 of the text, which tells rows of one doc_id apart.
    """
    rows = staged(sketches(documents, size), "near-sketches")
    nodes = staged(
        rows.filter("n_shingles > 0").groupBy("node", "check", "n_shingles").agg(
            F.min_by(F.struct("doc_id", "text_key"), F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("row"),
            F.first("sketch").alias("sketch")).select("node", "check", "n_shingles", "row.*", "sketch"), "near-nodes")
    label = connected(documents, nodes, size, percent)
    named = nodes.select("node", "doc_id").join(label, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = named.join(least, "component").select("node", "component_id")
    out = rows.select("doc_id", "text_key", "n_shingles", "node").withColumn(
        "node", F.when(F.col("n_shingles") > 0, F.col("node"))).join(named, "node", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"), *(["text_key"] if keyed else []))


def op8_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents on four-word shingles."""
    return near_duplicates(table(spark, sf_dir, "documents"), size=4, percent=80)


OP8_SQL = """
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
s AS (SELECT DISTINCT doc_id, hash(array_to_string(w[i:i + 3], ' ')) AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
l AS (SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
    FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2)
  JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 80 * (p.n + q.n - c)),
r AS (SELECT doc_id, doc_id AS reached FROM d UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.reached = l.a),
c AS (SELECT doc_id, min(reached) AS component_id FROM r GROUP BY 1)
SELECT c.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, c.doc_id = component_id AS kept
FROM c LEFT JOIN n USING (doc_id)"""
