"""Quality classifier from positive and unlabelled documents.

A logistic model over statistics of the text is fitted by the non-negative unbiased risk:
with class prior p, trusted positives P and unlabelled texts U,

    risk = p * R(P, +) + max(0, R(U, -) - p * R(P, -)),

and where the second term falls below zero, its gradient is followed back to zero.
Trusted positives are training rows labelled 1, at most ``SAMPLE`` of them, chosen by a
hash of their id.  Unlabelled texts are all training documents, with or without a label;
their features are written once, and every step of the fit, like the mean and scale of the
features, is one pass over all of them whose sums per coordinate reach the driver.

The prior is estimated from positives and unlabelled texts alone: a first model tells the
two apart, and of the ratios (share of U above a score) / (share of P above it) the least
one bounds the prior; the errors of both shares are added before the least is chosen.
Other labels are used for nothing.

Defined results: a null text is an empty one and is scored as such; texts of any length
are taken whole; a null ``doc_id`` is not held out and has no label; rows that repeat are
scored each; several labels of one doc_id count as 1 only if all are 1; other columns are
not looked at.  Without any positive, or without training texts, every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ledgerflow.llm import words as W
from ledgerflow.llm.common import remainder, staged, table

SAMPLE = 20_000  # at most so many positives
THRESHOLD = 0.3
PASSES = 40  # at most so many steps of a fit; it ends by itself before
GAIN = 1e-7  # a fit ends where a step promises less than this
RIDGE = 1e-3
PAIR_BINS = 64

KINDS = {
    "lower": lambda b: 97 <= b <= 122, "upper": lambda b: 65 <= b <= 90, "digit": lambda b: 48 <= b <= 57,
    "blank": lambda b: b in W.BLANKS, "line": lambda b: b == 10, "high": lambda b: b >= 128,
    "stop": lambda b: b in b".,;:", "mark": lambda b: b in b"!?", "bar": lambda b: b in b"|",
    "sign": lambda b: b in b"#$%&*@^~=+<>{}[]\\_`", "other": lambda b: b in b"\"'()/-",
}
TABLES = [W.byte_table(test) for test in KINDS.values()]


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts, features): shares of byte kinds, word statistics, hashed pairs of signs."""
    texts = len(offsets) - 1
    sizes = np.diff(offsets)
    per = 1 / np.maximum(sizes, 1)
    owner = np.repeat(np.arange(texts), sizes)
    share = lambda mask: np.bincount(owner[mask], minlength=texts) * per
    columns = [share(t[data]) for t in TABLES]
    words = W.split_words(data, offsets, W.UNBLANK, lower=True)
    text, count = W.text_of(words), np.diff(words.first)
    per_word = 1 / np.maximum(count, 1)
    mean = lambda values: np.bincount(text, values, texts) * per_word
    length = (words.end - words.start).astype(float)
    columns += [np.log1p(sizes), np.log1p(count), mean(length) / 10, mean(length > 20), mean(length < 3)]
    # repetition: words as their predecessor, and distinct words and word pairs
    same = np.zeros(len(text))
    same[1:] = (words.values[1:] == words.values[:-1]) & (text[1:] == text[:-1])
    pairs = W.gram_values(words.values, 2) if len(text) else words.values
    columns.append(mean(same))
    for values in (words.values, pairs):
        ranked = np.lexsort((values, text))
        fresh = np.ones(len(text), dtype=bool)
        fresh[1:] = (values[ranked][1:] != values[ranked][:-1]) | (text[1:] != text[:-1])
        columns.append(np.bincount(text[ranked], fresh, texts) * per_word)
    # words wholly of capitals, and words that end in a sign
    upper = np.concatenate([[0], np.cumsum(TABLES[1][data])])
    lower = np.concatenate([[0], np.cumsum(TABLES[0][data])])
    columns.append(mean((upper[words.end] - upper[words.start] > 1) & (lower[words.end] == lower[words.start])))
    signs = ~(TABLES[0] | TABLES[1] | TABLES[2] | TABLES[3] | TABLES[5])
    columns.append(mean(signs[data[words.end - 1]]))
    # pairs of neighbouring signs, hashed
    near = np.flatnonzero(signs[data[:-1]] & signs[data[1:]] & (owner[1:] == owner[:-1])) if len(data) > 1 else []
    bins = np.zeros((texts, PAIR_BINS))
    if len(near):
        slot = (data[near].astype(np.int64) * 131 + data[near + 1]) % PAIR_BINS
        np.add.at(bins, (owner[near], slot), 1)
    return np.column_stack([*columns, np.sqrt(bins * per_word[:, None])])


def thinned(rows: DataFrame, key) -> DataFrame:
    """About SAMPLE of the rows, by a hash of their key; all of them where they are fewer."""
    share = SAMPLE / max(rows.count(), SAMPLE)
    return rows.filter(F.pmod(F.xxhash64(*key), F.lit(1 << 30)) < int(share * (1 << 30)))


def text_features(texts: DataFrame) -> DataFrame:
    """(x): the features of each text as 32-bit floats."""

    def take(batches):
        for batch in batches:
            for _, _, data, offsets in W.text_slices(batch.column(0)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r.tobytes() for r in features(data, offsets).astype(np.float32)], pa.binary())],
                    names=["x"])

    return texts.select("text").mapInArrow(take, "x binary")


def matrix(rows: Sequence[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(rows), dtype=np.float32).reshape(len(rows), -1).astype(float)


def sums(rows: DataFrame, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all rows of the vector that ``of`` makes of a block of features.

    A task gives one row per coordinate; Spark adds them, so what reaches the driver does
    not grow with the rows or the tasks.
    """

    def add(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                part = of(matrix(batch.column(0).to_pylist()))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["at", "value"])

    found = rows.mapInArrow(add, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(len(found))
    for row in found:
        out[row.at] = row.value
    return out


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def standard(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Features ready for the model, the constant last."""
    return np.column_stack([np.clip((x - mean) / scale, -8, 8), np.ones(len(x))])


def loss_sums(x: np.ndarray, weights: np.ndarray, sign: int) -> np.ndarray:
    """Loss of the label -sign, its slope and its curvature, summed over the rows, in one vector."""
    at = sigmoid(x @ weights)
    near = at if sign > 0 else at - 1
    curve = (x * (at * (1 - at))[:, None]).T @ x
    return np.concatenate([[softplus(sign * (x @ weights)).sum()], near @ x, curve.ravel()])


def split(total: np.ndarray, rows: int) -> tuple[float, np.ndarray, np.ndarray]:
    """(loss, slope, curvature) per row, from their sums."""
    side = int(np.sqrt(len(total)))
    while 1 + side + side * side > len(total):
        side -= 1
    return total[0] / rows, total[1 : side + 1] / rows, total[side + 1 :].reshape(side, side) / rows


def apart(unlabelled: Callable, positive: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weights that tell positives from unlabelled texts; Newton steps, halved where they do not help."""
    trusted = lambda w: split(loss_sums(positive, w, -1), len(positive))
    return descended(lambda w: (*(u + p for u, p in zip(unlabelled(w), trusted(w))), None), weights, 10 * RIDGE)


def non_negative(unlabelled: Callable, positive: np.ndarray, prior: float, weights: np.ndarray) -> np.ndarray:
    """Weights of least non-negative unbiased risk.

    With the log loss R(P, +) - R(P, -) is minus the mean of the model's sums over P, so
    the unbiased risk is convex and Newton steps apply while its second term is positive.
    """
    centre = positive.mean(axis=0)

    def risk(w):
        loss, slope, curve = unlabelled(w)
        against, against_slope, _ = split(loss_sums(positive, w, 1), len(positive))
        rest = loss - prior * against
        back = None if rest >= 0 else (-rest, slope - prior * against_slope)
        return loss - prior * (centre @ w), slope - prior * centre, curve, back

    return descended(risk, weights, RIDGE)


def descended(risk: Callable, weights: np.ndarray, ridge: float) -> np.ndarray:
    """The minimum of a risk given as (value, slope, curvature, way back or None)."""
    held = np.append(np.full(len(weights) - 1, ridge), 1e-9)
    best, step = None, None
    for _ in range(PASSES):
        value, slope, curve, back = risk(weights)
        if back is not None:
            lack, way = back
            if best is not None and step is not None and np.abs(step).max() < 1e-4:
                break
            # along the gradient of the negative term, as far as it takes to zero
            weights = weights + way * lack / max(way @ way, 1e-12)
            step = weights - best[1] if best is not None else None
            continue
        value += held @ weights**2 / 2
        slope, curve = slope + held * weights, curve + np.diag(held)
        if best is not None and value > best[0] + GAIN:
            step = (weights - best[1]) / 2
            if np.abs(step).max() < 1e-4:
                break
            weights = best[1] + step
            continue
        step = -np.linalg.solve(curve + 1e-9 * np.eye(len(slope)), slope)
        best = value, weights
        if -(slope @ step) < GAIN:
            break
        weights = weights + step
    return best[1] if best is not None else weights


def estimated_prior(positive: np.ndarray, above: Callable, unlabelled: int) -> float:
    """The class prior from scores of positives and ``above(bars)``, counts of U at or above each bar."""
    bars = np.unique(np.quantile(positive, np.linspace(0, 0.95, 96)))
    of_p = (positive >= bars[:, None]).mean(axis=1)
    of_u = above(bars) / unlabelled
    error = np.sqrt(np.log(40) / 2) * (1 / np.sqrt(unlabelled) + 1 / np.sqrt(len(positive)))
    at = int(np.argmin((of_u + error) / of_p))
    least = 1 / (unlabelled + 2)
    return float(np.clip(of_u[at] / of_p[at], least, 1 - least))


def trained(documents: DataFrame, labels: DataFrame, positive_label: int = 1):
    """(mean, scale, weights), or 0.5 where there is nothing to learn from."""
    learn = F.coalesce(remainder(F.col("doc_id"), 5) != 0, F.lit(False))
    rows = documents.select(F.col("doc_id").cast("long"), "text").filter(learn)
    marks = labels.select(F.col("doc_id").cast("long"), F.col("quality")).filter(learn & F.col("quality").isNotNull())
    good = marks.groupBy("doc_id").agg(F.min((F.col("quality") == positive_label).cast("int")).alias("good"))
    # at most SAMPLE ids, so this side may travel to every task
    ids = thinned(good.filter("good = 1").select("doc_id"), ["doc_id"]).limit(SAMPLE)
    trusted = text_features(rows.join(F.broadcast(ids), "doc_id", "left_semi")).limit(SAMPLE).collect()
    if not trusted:
        return 0.5
    texts = staged(text_features(rows), "quality-features")
    moments = sums(texts, lambda x: np.concatenate([[len(x)], x.sum(axis=0), (x**2).sum(axis=0)]))
    count, side = int(moments[0]), len(moments) // 2
    mean = moments[1 : side + 1] / count
    scale = np.sqrt(np.maximum(moments[side + 1 :] / count - mean**2, 0)) + 1e-3
    positive = standard(matrix([r.x for r in trusted]), mean, scale)

    def unlabelled(weights):
        return split(sums(texts, lambda x: loss_sums(standard(x, mean, scale), weights, 1)), count)

    first = apart(unlabelled, positive, np.zeros(side + 1))
    prior = estimated_prior(
        positive @ first,
        lambda bars: sums(texts, lambda x: ((standard(x, mean, scale) @ first) >= bars[:, None]).sum(axis=1) * 1.0),
        count)
    start = np.append(np.zeros(side), np.log(prior / (1 - prior)))
    return mean, scale, non_negative(unlabelled, positive, prior, start)


def quality_scores(documents: DataFrame, labels: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Per row: its carried columns, doc_id, held_out, score and predicted."""
    model = trained(documents, labels)
    extra = [c for c in carry if c not in ("doc_id", "held_out", "score", "predicted")]
    rows = documents.select(
        F.col("doc_id").cast("long"), "text", *[F.col(f"`{c}`") for c in extra if c != "text"])

    def score(batches):
        for batch in batches:
            texts = batch.column(1)
            out = np.zeros(len(texts))
            for low, high, data, offsets in W.text_slices(texts):
                if isinstance(model, float):
                    out[low:high] = model
                else:
                    mean, scale, weights = model
                    out[low:high] = sigmoid(standard(features(data, offsets).astype(np.float32), mean, scale) @ weights)
            columns = [batch.column("doc_id"), *[batch.column(c) for c in extra], pa.array(out)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *extra, "score"])

    schema = StructType([StructField("doc_id", LongType())] + [documents.schema[c] for c in extra])
    found = rows.mapInArrow(score, schema.add("score", "double"))
    held = F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    return found.withColumns({
        "held_out": held, "predicted": (F.col("score") >= THRESHOLD).cast("int")})


def op9_nnpu(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    scores = quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scores.select("doc_id", "held_out", "score", "predicted")
