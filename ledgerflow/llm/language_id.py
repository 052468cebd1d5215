"""Language identification of texts in several languages at once.

Each training document adds its byte n-grams, hashed into a table of fixed size, to the
counts of its language.  A word's likelihood under a language is that of its n-grams.  For
every document the proportions of the languages are estimated by expectation-maximisation
over its distinct words, until the log likelihood is as good as at its maximum; languages are then taken away, the least one first, as long as
the log likelihood pays less for one more than a penalty that grows with the length.  The
prediction is the language of the greatest proportion, the score that proportion.

Defined results: a null text, an empty one and one without a letter is ``und`` with score
0, and so is every text where nothing could be learnt; a null lang is not learnt from; a
null ``doc_id`` is learnt from and not held out; rows that repeat are predicted each;
other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm import words as W
from ledgerflow.llm.common import remainder, table

BINS = 1 << 14  # hashed n-grams of each order
ORDERS = (1, 2, 3)
GAP = 1e-3  # of a log likelihood to its maximum, at which a text is settled
STILL = 1e-12  # change of the shares at which numbers have no more to give
SMOOTH = 0.5
SLICE = 512 << 10  # bytes at once; every byte begins an n-gram of each order
# letters, and the marks of other scripts; digits and signs end a word
LETTERS = W.byte_table(lambda b: b >= 0x80 or chr(b).isalpha())


def word_grams(data: np.ndarray, offsets: np.ndarray):
    """(words, gram bins, word of each gram) over the words of a slice of texts."""
    words = W.split_words(data, offsets, LETTERS, lower=True)
    inside = np.zeros(len(data), dtype=bool)
    inside[:] = LETTERS[data]
    owner = np.cumsum(np.bincount(words.start, minlength=len(data) + 1)[: len(data)]) - 1 if len(data) else np.zeros(0, int)
    low = W.LOWER[data].astype(np.uint64)
    bins, owners = [], []
    for order in ORDERS:
        # n-grams with the word's edges, which count as one more byte
        value = np.zeros(len(data), dtype=np.uint64)
        whole = np.zeros(len(data), dtype=bool)
        if len(data):
            padded = np.where(inside, low, np.uint64(0x20))
            same = inside.copy()
            value = padded.copy()
            whole = inside.copy()
            for step in range(1, order):
                nxt = np.full(len(data), 0x20, dtype=np.uint64)
                ahead = np.zeros(len(data), dtype=bool)
                ahead[:-step] = inside[step:] & (owner[step:] == owner[:-step])
                nxt[:-step] = np.where(ahead[:-step], padded[step:], np.uint64(0x20))
                same &= ahead
                value = value * np.uint64(257) + nxt
        at = np.flatnonzero(whole)
        bins.append((W.mix(value[at] + np.uint64(order << 40)) % np.uint64(BINS)).astype(np.int64) + BINS * (order - 1))
        owners.append(owner[at])
    return words, np.concatenate(bins), np.concatenate(owners)


def learnt(documents: DataFrame) -> tuple[list[str], np.ndarray]:
    """(languages, log likelihood of each gram bin under each of them)."""
    training = F.coalesce(remainder(F.col("doc_id"), 4) != 2, F.lit(True))
    rows = documents.select(F.col("doc_id").cast("long"), "text", F.col("lang").cast("string")).filter(
        training & F.col("lang").isNotNull()).select("text", "lang")

    def count(batches):
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            names = np.array(batch.column(1).to_pylist(), dtype=object)
            for low, high, data, offsets in W.text_slices(batch.column(0), SLICE):
                words, bins, owners = word_grams(data, offsets)
                text = W.text_of(words)[owners]
                for name in set(names[low:high]):
                    mine = (names[low:high] == name)[text]
                    found = np.bincount(bins[mine], minlength=BINS * len(ORDERS))
                    totals[name] = totals[name] + found if name in totals else found
        for name, found in totals.items():
            at = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(found[at])],
                names=["lang", "bin", "count"])

    # a row per language and bin at most comes to the driver: both numbers are fixed
    sums = rows.mapInArrow(count, "lang string, bin int, count long").groupBy("lang", "bin").agg(
        F.sum("count").alias("count"))
    found = sums.groupBy("lang").agg(F.collect_list(F.struct("bin", "count")).alias("counts")).orderBy("lang").collect()
    table_ = np.zeros((BINS * len(ORDERS), len(found)))
    for k, row in enumerate(found):
        at = np.array([(c.bin, c["count"]) for c in row.counts])
        table_[at[:, 0], k] = at[:, 1]
    table_ += SMOOTH
    for order in range(len(ORDERS)):
        some = slice(order * BINS, (order + 1) * BINS)
        table_[some] /= table_[some].sum(axis=0)
    return [row.lang for row in found], np.log(table_)


def mixtures(likelihood: np.ndarray, text: np.ndarray, weight: np.ndarray, texts: int):
    """(proportions, log likelihood) of every text, after the least likely languages went.

    ``likelihood``: log likelihood of each word under each language.
    """
    count = likelihood.shape[1]
    top = likelihood.max(axis=1, keepdims=True) if count else likelihood
    ratio = np.exp(likelihood - top)
    heads = np.searchsorted(text, np.arange(texts + 1))
    some = np.flatnonzero(np.diff(heads))
    sizes = np.diff(heads)[some]
    total = np.add.reduceat(weight, heads[some]) if len(some) else np.zeros(0)

    def climb(which, share):
        """Shares of the texts ``which`` within GAP of the best ones, and the fits."""
        out, fit = share.copy(), np.zeros(len(which))
        live = np.arange(len(which))
        while len(live):
            count_ = sizes[which[live]]
            first = np.cumsum(count_) - count_
            at = np.repeat(np.arange(len(live)), count_)
            rows = np.arange(len(at)) + (heads[some][which[live]] - first)[at]
            own, times, peak, whole = ratio[rows], weight[rows], top[rows, 0], total[which[live]]
            now, open_ = out[live], np.ones(len(live), dtype=bool)
            while True:
                mixed = np.maximum((own * now[at]).sum(axis=1), 1e-300)
                slope = np.add.reduceat(own * (times / mixed)[:, None], first, axis=0)
                # the log likelihood is concave: it cannot rise by more than this
                rest = np.where(now > 0, slope, 0).max(axis=1) - whole
                then = now * slope / whole[:, None]
                settled = open_ & ~((rest > GAP) & (np.abs(then - now).max(axis=1) > STILL))
                if settled.any():
                    fits = np.add.reduceat(times * (np.log(mixed) + peak), first)
                    out[live[settled]], fit[live[settled]] = now[settled], fits[settled]
                    open_ &= ~settled
                    if open_.sum() <= 0.8 * len(live):
                        break
                now = np.where(open_[:, None], then, now)
            out[live[open_]] = now[open_]
            live = live[open_]
        return out, fit

    share, fit = climb(np.arange(len(some)), np.full((len(some), count), 1 / max(count, 1)))
    penalty = 2 + 0.5 * np.log(total)
    # a text that keeps its languages once would keep them ever after
    left = np.flatnonzero((share > 0).sum(axis=1) > 1)
    while len(left):
        fewer = share[left]
        fewer[np.arange(len(left)), np.where(fewer > 0, fewer, np.inf).argmin(axis=1)] = 0
        fewer /= np.maximum(fewer.sum(axis=1, keepdims=True), 1e-300)
        fewer, worse = climb(left, fewer)
        better = fit[left] - worse <= penalty[left]
        left, fewer, worse = left[better], fewer[better], worse[better]
        share[left], fit[left] = fewer, worse
        left = left[(fewer > 0).sum(axis=1) > 1]
    return some, share, fit


def languages(documents: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score, and the languages with their shares."""
    names, table_ = learnt(documents)
    rows = documents.select(
        F.col("doc_id").cast("long"), "text",
        F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("lettered"))
    shared = documents.sparkSession.sparkContext.broadcast(table_.astype(np.float32))
    kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))

    def predict(batches):
        scores = shared.value
        for batch in batches:
            lettered = np.array(batch.column(2))
            out = [("und", 0.0, [])] * len(batch)
            for low, high, data, offsets in W.text_slices(batch.column(1), SLICE) if names else ():
                words, bins, owners = word_grams(data, offsets)
                if not len(words.values):
                    continue
                # a word is as likely as its n-grams, the orders weighing alike; equal words are
                # looked up once, and in a text count once with their number
                values, firsts, which = np.unique(words.values, return_index=True, return_inverse=True)
                of = np.full(len(words.values), -1)
                of[firsts] = np.arange(len(values))
                owners = of[owners]
                bins, owners = bins[owners >= 0], owners[owners >= 0]
                order = np.argsort(owners, kind="stable")
                heads = np.searchsorted(owners[order], np.arange(len(values)))
                word = np.add.reduceat(scores[bins[order]], heads, axis=0).astype(float) / len(ORDERS)
                pairs, times = np.unique(W.text_of(words) * len(values) + which, return_counts=True)
                text, which = np.divmod(pairs, len(values))
                some, share, _ = mixtures(word[which], text, times.astype(float), high - low)
                for row, shares in zip(some.tolist(), share):
                    if lettered[low + row]:
                        best = int(shares.argmax())
                        rank = [k for k in np.argsort(-shares, kind="stable") if shares[k] > 0]
                        out[low + row] = (names[best], min(1.0, float(shares[best])),
                                          [{"lang": names[k], "share": float(shares[k])} for k in rank])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.float64()),
                 pa.array([o[2] for o in out], kind)], names=["doc_id", "lang_pred", "score", "shares"])

    found = rows.mapInArrow(
        predict, "doc_id long, lang_pred string, score double, shares array<struct<lang:string,share:double>>")
    return found.withColumn("held_out", F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False)))


def op10_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    return languages(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")
