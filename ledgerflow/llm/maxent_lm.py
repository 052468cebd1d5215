"""Hashed maximum-entropy language model with a class-factored softmax.

A token belongs to a slot: each of the most frequent tokens to one of its own, all others
to one by the hash of their last bytes.  Slots are grouped into classes, and

    P(token | history) = P(class | history) * P(slot | class, history) * P(token | slot).

The first two factors are softmaxes over hashed features of the history: the words before
(as a unigram and a bigram) and the slots one, two and three places back (skip features).
They start from the slot frequencies and are trained by distributed gradient updates: every
trainer runs minibatches over its documents from common weights; what the trainers changed
is averaged by how often each row was updated, and the next part of the documents goes on
from there.  Every training document is used once.  There are about as many trainers as
the cluster has cores, whatever the number of input splits.  The last factor is the
token's add-one share of its slot, where all unseen tokens count as one.

The model grows with the vocabulary counted (:func:`sizes`): the slots, a quarter of them
of tokens of their own, with its square root, the hashed rows in proportion to it, these up
to what every trainer can hold (``WEIGHTS``).

Token counts are exact, over all training documents.  A fixed number of the most frequent
tokens travels with the tasks; all rarer ones are joined.

Defined results: a null text is an empty one, which has the end token alone; a null
``doc_id`` is learnt from and not held out; rows that repeat are scored each; other
columns are not looked at.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm import words as W
from ledgerflow.llm.common import remainder, staged, table

SIDE = 32  # classes, and slots of a class; the least
SLOTS = SIDE * SIDE
HEAD = 1 << 16  # tokens whose counts travel with the tasks
CLASS_ROWS = 1 << 14  # the least; the slots within classes have twice as many
WEIGHTS = 1 << 25  # that a trainer holds
ROW_CHUNK = 1 << 10
BATCH = 4096
RATE = 0.25
ROUNDS = 2
END = np.uint64(0x1D)  # the end token's value
FEATURES = 5


def sizes(vocabulary: int) -> tuple[int, int]:
    """(side, class rows) of the model for a vocabulary."""
    side = max(SIDE, math.ceil(vocabulary ** 0.25))
    rows = max(CLASS_ROWS, 1 << max(vocabulary // 64, 1).bit_length() - 1)
    while rows > CLASS_ROWS and 3 * rows * side > WEIGHTS:
        rows //= 2
    return side, rows


def own_slots(slots: int) -> int:
    """How many of the slots are those of a single token."""
    return slots // 4


def order_of(keys: np.ndarray) -> np.ndarray:
    """A stable order of keys under 2**32; keys of 16 bits are sorted by counting."""
    order = np.argsort(keys.astype(np.uint16), kind="stable")
    high = (keys >> 16).astype(np.uint16)
    return order[np.argsort(high[order], kind="stable")] if high.any() else order


def run_sums(values: np.ndarray, order: np.ndarray, heads: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Sums of runs of the rows ``values[order]``; run ``k`` begins at ``heads[k]``.

    Most runs are of one row, which is its own sum.
    """
    total = np.empty((len(heads), values.shape[1]), dtype=values.dtype)
    single = times == 1
    total[single] = values.take(order[heads[single]], axis=0)
    several = np.flatnonzero(~single)
    if len(several):
        size = times[several]
        until = np.cumsum(size)
        at = np.arange(until[-1]) + np.repeat(heads[several] - (until - size), size)
        total[several] = np.add.reduceat(values.take(order[at], axis=0), until - size, axis=0)
    return total


class Tokens:
    """All tokens of a slice of texts, each text's end token included.

    ``tail`` is the hash of the last bytes; ``Head.slots_of`` adds the slots.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        words = W.split_words(data, offsets, W.UNBLANK, lower=True)
        texts = len(offsets) - 1
        self.text = np.repeat(np.arange(texts), np.diff(words.first) + 1)
        self.begin = words.first[:-1] + np.arange(texts)
        self.count = np.diff(words.first) + 1
        place = np.arange(len(words.values)) + W.text_of(words)
        self.value = np.full(len(self.text), END, dtype=np.uint64)
        self.value[place] = words.values
        # the last three bytes of a word, or as many as it has
        tail = np.zeros(len(words.values), dtype=np.uint64)
        for back in (1, 2, 3):
            at = words.end - back
            some = at >= words.start
            tail[some] = tail[some] << np.uint64(8) | W.LOWER[data[at[some]]].astype(np.uint64)
        self.tail = np.zeros(len(self.text), dtype=np.int64)
        self.tail[place] = (W.mix(tail) >> np.uint64(33)).astype(np.int64)

    def back(self, values: np.ndarray, steps: int, empty):
        """Per token the entry ``steps`` tokens before it in its text."""
        out = np.full(len(values), empty, dtype=values.dtype)
        inner = np.arange(len(values)) - np.repeat(self.begin, self.count) >= steps
        at = np.flatnonzero(inner)
        out[at] = values[at - steps]
        return out

    def features(self) -> np.ndarray:
        """(tokens, FEATURES) 64-bit values of the history's features."""
        one, two = (self.back(self.value, k, np.uint64(0)) for k in (1, 2))
        slots = [self.back(self.slot, k, -1).astype(np.uint64) for k in (1, 2, 3)]
        kinds = [*slots, one, W.mix(one * np.uint64(W.BASE) + two)]
        return np.stack([W.mix(v + np.uint64(k * W.MIX[0] % (1 << 64))) for k, v in enumerate(kinds)], axis=1)


class Model:
    """Row-wise hashed weights of both softmaxes and their fixed starting scores."""

    def __init__(self, slot_counts: np.ndarray, class_rows: int = CLASS_ROWS):
        self.side, self.class_rows = math.isqrt(len(slot_counts)), class_rows
        counts = slot_counts.reshape(self.side, self.side) + 1e-3
        self.class_start = np.log(counts.sum(axis=1)).astype(np.float32)
        self.member_start = np.log(counts).astype(np.float32)
        self.weights = np.zeros((3 * class_rows, self.side), dtype=np.float32)

    def rows(self, features: np.ndarray, group: np.ndarray | None) -> np.ndarray:
        if group is None:
            return (features & np.uint64(self.class_rows - 1)).astype(np.int64)
        mixed = W.mix(features + (group[:, None] + 1).astype(np.uint64) * np.uint64(W.MIX[1]))
        return self.class_rows + (mixed & np.uint64(2 * self.class_rows - 1)).astype(np.int64)

    def softmax(self, rows: np.ndarray, start: np.ndarray) -> np.ndarray:
        scores = self.weights.take(rows[:, 0], axis=0)
        scores += start
        for k in range(1, rows.shape[1]):
            scores += self.weights.take(rows[:, k], axis=0)
        scores -= scores.max(axis=1, keepdims=True)
        np.exp(scores, out=scores)
        scores /= (scores @ np.ones(self.side, dtype=np.float32))[:, None]
        return scores

    def parts(self, features: np.ndarray, slots: np.ndarray):
        """(rows, outcome, starting scores) of both softmaxes."""
        group, member = slots // self.side, slots % self.side
        yield self.rows(features, None), group, self.class_start
        yield self.rows(features, group), member, self.member_start[group]

    def log10(self, features: np.ndarray, slots: np.ndarray) -> np.ndarray:
        """log10 P(slot | history) of each token."""
        out = np.zeros(len(slots))
        for low in range(0, len(slots), BATCH):
            some = slice(low, low + BATCH)
            for rows, outcome, start in self.parts(features[some], slots[some]):
                chances = self.softmax(rows, start)
                out[some] += np.log10(np.maximum(chances[np.arange(len(outcome)), outcome], 1e-30))
        return out

    def learn(self, features: np.ndarray, slots: np.ndarray, squares: np.ndarray, updates: np.ndarray):
        """One minibatch step for every BATCH tokens."""
        for low in range(0, len(slots), BATCH):
            some = slice(low, low + BATCH)
            for rows, outcome, start in self.parts(features[some], slots[some]):
                slope = self.softmax(rows, start)
                slope[np.arange(len(outcome)), outcome] -= 1
                flat = rows.reshape(-1)
                order = order_of(flat)
                ranked = flat[order]
                heads = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
                touched = ranked[heads]
                times = np.diff(np.append(heads, len(ranked)))
                step = run_sums(slope, order // rows.shape[1], heads, times)
                step /= times.astype(np.float32)[:, None]
                squares[touched] += np.einsum("ij,ij->i", step, step) / self.side * times
                # an AdaGrad step per row
                rate = RATE * times / np.sqrt(times * (squares[touched] + 1e-6) * 20 + 1.0)
                step *= np.minimum(rate, 2.0).astype(np.float32)[:, None]
                self.weights[touched] = self.weights.take(touched, axis=0) - step
                updates[touched] += times


def restored(kind, values: dict):
    """An object from its attributes; broadcasts hold plain arrays, not classes."""
    made = kind.__new__(kind)
    made.__dict__.update(values)
    return made


def training(key: Column) -> Column:
    """Rows to learn from."""
    return F.coalesce(remainder(key, 7) != 2, F.lit(True))


def token_counts(documents: DataFrame) -> DataFrame:
    """(token, tail, count) over all texts."""

    def count(batches):
        for batch in batches:
            for _, _, data, offsets in W.text_slices(batch.column(0)):
                tokens = Tokens(data, offsets)
                values, first, counts = np.unique(tokens.value, return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values.view(np.int64)), pa.array(tokens.tail[first]), pa.array(counts)],
                    names=["token", "tail", "count"])

    rows = documents.select("text").mapInArrow(count, "token long, tail long, count long")
    return rows.groupBy("token").agg(F.min("tail").alias("tail"), F.sum("count").alias("count"))


class Head:
    """Counts and slots of the most frequent tokens, by binary search."""

    def __init__(self, rows, slots: int = SLOTS):
        self.first, self.shared = own_slots(slots), slots - own_slots(slots)
        ranked = sorted(rows, key=lambda r: (-r.count_, r.token))
        own = {r.token: k for k, r in enumerate(ranked[:self.first])}
        self.own = list(own)
        ranked.sort(key=lambda r: np.int64(r.token).view(np.uint64))
        self.tokens = np.array([r.token for r in ranked], dtype=np.int64).view(np.uint64)
        self.counts = np.array([r.count_ for r in ranked], dtype=np.int64)
        self.slots = np.array([own.get(r.token, self.first + r.tail % self.shared) for r in ranked], dtype=np.int64)

    def find(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which are known, their places)."""
        if not len(self.tokens):
            return np.zeros(len(values), bool), np.zeros(0, np.int64)
        place = np.minimum(np.searchsorted(self.tokens, values), len(self.tokens) - 1)
        known = self.tokens[place] == values
        return known, place[known]

    def slots_of(self, tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """(known, places); the tokens get their slots."""
        known, place = self.find(tokens.value)
        tokens.slot = self.first + tokens.tail % self.shared
        tokens.slot[known] = self.slots[place]
        return known, place


def summed(parts: DataFrame, schema: str, levels: int = 3, fan_in: int = 32) -> DataFrame:
    """Sums of the trainers' changes per chunk, by a tree of bounded fan-in."""

    def add(rows: pa.Table) -> pa.Table:
        total = {}
        for name in ("weights", "updates"):
            arrays = [np.frombuffer(v.as_buffer(), dtype=np.float32) for v in rows.column(name)]
            total[name] = sum(arrays[1:], arrays[0].copy()).tobytes()
        return pa.table({"chunk": rows.column("chunk")[:1], "part": rows.column("part")[:1],
                         **{k: pa.array([v], pa.binary()) for k, v in total.items()}})

    for _ in range(levels):
        parts = parts.withColumn("part", (F.col("part") / fan_in).cast("int"))
        parts = parts.groupBy("chunk", "part").applyInArrow(add, schema)
    return parts


def trained(documents: DataFrame, model: Model, head: Head) -> Model:
    """The model after one pass over the training documents, in ROUNDS parts."""
    schema = "chunk int, part int, weights binary, updates binary"
    context = documents.sparkSession.sparkContext
    rows = documents.select("text", F.pmod(F.xxhash64("text", F.lit("round")), F.lit(ROUNDS)).alias("turn"))
    trainers = 2 * context.defaultParallelism
    for turn in range(ROUNDS):
        shared = context.broadcast((vars(model), vars(head)))

        def learn(batches, shared=shared):
            own, known = restored(Model, shared.value[0]), restored(Head, shared.value[1])
            start, own.weights = own.weights, own.weights.copy()
            squares, updates = np.zeros(len(own.weights)), np.zeros(len(own.weights))
            for batch in batches:
                for _, _, data, offsets in W.text_slices(batch.column(0)):
                    tokens = Tokens(data, offsets)
                    known.slots_of(tokens)
                    own.learn(tokens.features(), tokens.slot, squares, updates)
            part = TaskContext.get().partitionId()
            for chunk, low in enumerate(range(0, len(own.weights), ROW_CHUNK)):
                some = slice(low, low + ROW_CHUNK)
                if updates[some].any():
                    times = updates[some].astype(np.float32)
                    sums = (own.weights[some] - start[some]) * times[:, None]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([chunk], pa.int32()), pa.array([part], pa.int32()),
                         pa.array([sums.tobytes()]), pa.array([times.tobytes()])],
                        names=["chunk", "part", "weights", "updates"])

        own_part = rows.filter(F.col("turn") == turn).select("text").coalesce(trainers)
        parts = own_part.mapInArrow(learn, schema)
        # as many rows come to the driver as the model has chunks
        for row in summed(parts, schema).toLocalIterator():
            some = slice(row.chunk * ROW_CHUNK, (row.chunk + 1) * ROW_CHUNK)
            sums = np.frombuffer(row.weights, dtype=np.float32).reshape(-1, model.side)
            times = np.frombuffer(row.updates, dtype=np.float32)
            hit = times > 0
            model.weights[some][hit] += sums[hit] / times[hit, None]
    return model


def scored(documents: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    rows = documents.select(F.col("doc_id").cast("long"), "text")
    learnt = rows.filter(training(F.col("doc_id")))
    vocabulary = staged(token_counts(learnt), "lm-vocabulary")
    frequent = vocabulary.orderBy(F.desc("count"), "token").limit(HEAD).withColumnRenamed("count", "count_").collect()
    n, v = vocabulary.agg(F.coalesce(F.sum("count"), F.lit(0)), F.count("*")).first()
    side, class_rows = sizes(v)
    head = Head(frequent, side * side)
    # tokens of slots of their own leave the slot of their last bytes
    own = np.zeros((2, side * side), dtype=np.int64)
    by_tail = (head.first + F.pmod("tail", F.lit(head.shared))).alias("slot")
    for row in vocabulary.groupBy(by_tail).agg(F.sum("count").alias("n"), F.count("*").alias("v")).collect():
        own[:, row.slot] += [row.n, row.v]
    at = {r.token: r for r in frequent}
    for slot, token in enumerate(head.own):
        own[:, head.first + at[token].tail % head.shared] -= [at[token].count_, 1]
        own[:, slot] += [at[token].count_, 1]
    model = trained(learnt, Model(own[0].astype(float), class_rows), head)
    context = documents.sparkSession.sparkContext
    shared = context.broadcast((vars(model), vars(head), np.log10(own.sum(axis=0) + 1.0)))

    def score(batches):
        model, head = restored(Model, shared.value[0]), restored(Head, shared.value[1])
        room = shared.value[2]
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            for low, high, data, offsets in W.text_slices(batch.column(1)):
                texts = high - low
                tokens = Tokens(data, offsets)
                known, place = head.slots_of(tokens)
                counts = np.log10(head.counts[place] + 1.0) if len(place) else np.zeros(0)
                given = model.log10(tokens.features(), tokens.slot) - room[tokens.slot]
                per_text = lambda which, values: np.bincount(tokens.text[which], values, texts)  # noqa: E731,B023
                rare = np.flatnonzero(~known)
                order = rare[np.lexsort((tokens.value[rare], tokens.text[rare]))]
                value, text = tokens.value[order], tokens.text[order]
                fresh = np.ones(len(order), dtype=bool)
                fresh[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
                heads = np.flatnonzero(fresh)
                own = number + np.arange(texts)
                number += texts
                nothing = np.zeros(len(heads))
                none = pa.nulls(len(heads), pa.int64())
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([own, own[text[heads]]])),
                    pa.concat_arrays([batch.column(0)[low:high], none]),
                    pa.concat_arrays([pa.array(tokens.count.astype(np.int64)), none]),
                    # a document's own row has no token; its number keeps the keys spread
                    pa.array(np.concatenate([W.mix(own.astype(np.uint64)), value[heads]]).view(np.int64)),
                    pa.array(np.concatenate([np.zeros(texts, np.int64), np.diff(np.append(heads, len(order)))])),
                    pa.array(np.concatenate([per_text(known, np.ones(len(place))), nothing])),
                    pa.array(np.concatenate([per_text(known, counts), nothing])),
                    pa.array(np.concatenate([np.bincount(tokens.text, given, texts), nothing]))],
                    names=["row", "doc_id", "n_tokens", "token", "times", "known", "counts", "given"])

    out = rows.mapInArrow(
        score, "row long, doc_id long, n_tokens long, token long, times long, known double, counts double, given double")
    joined = out.join(vocabulary.select("token", "count"), "token", "left")
    found = F.when(F.col("times") > 0, F.col("count"))
    sums = joined.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_tokens").alias("n_tokens"),
        (F.sum("known") + F.coalesce(F.sum(F.when(found > 0, F.col("times"))), F.lit(0))).cast("long").alias("n_known"),
        (F.sum("counts") + F.coalesce(F.sum(F.col("times") * F.log10(found + 1.0)), F.lit(0.0))).alias("counts"),
        F.sum("given").alias("given"))
    return sums.select(
        "doc_id", (~training(F.col("doc_id"))).alias("held_out"), "n_tokens", "n_known",
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("counts") - F.col("n_tokens") * float(np.log10(n + v + 1.0))).alias("base_score"),
        (F.col("counts") + F.col("given")).alias("score"))


def op4_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log probability of every document."""
    return scored(table(spark, sf_dir, "documents"))
