"""Benchmark decontamination by winnowing.

Of every run of ``window - gram + 1`` consecutive word k-grams the one of least hash is a
fingerprint.  Two texts that share ``window`` words choose the same fingerprint inside
them, so a join on fingerprints misses no such span.  Hits are then extended to whole
windows, whose hashes are joined in turn.  An item of fewer than ``window`` words is one
window; all runs of its length are fingerprints.

Nothing depends on the size of either side: both joins are Spark's, which broadcasts the
benchmark's side only where its own size check allows.  A bitmap of fixed size, built
from the benchmark, keeps most fingerprints that cannot join from leaving the task; it
lets every one pass that can.

Defined results: null and empty texts have no words and no hits; an item without words
has no window; a null ``item_id`` marks words but is not listed; rows that repeat are
judged each; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm import words as W
from ledgerflow.llm.common import staged, table

BITS = 22  # bitmap of 2**22 bits, half a megabyte

ITEM_SCHEMA = "item_id long, length int, fingerprint long, span long"
HIT_SCHEMA = (
    "doc_id long, copy long, n_words long, fingerprint long, spans array<struct<start:int,length:int,span:long>>"
)


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def text_key(words: W.Words) -> np.ndarray:
    """One 64-bit value per text, of its whole word sequence."""
    count = len(words.first) - 1
    place = np.arange(len(words.values)) - np.repeat(words.first[:-1], np.diff(words.first))
    mixed = W.mix(words.values + place.astype(np.uint64) * np.uint64(W.MIX[0]))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)])
    total = sums[words.first[1:]] - sums[words.first[:-1]]
    return W.mix(total + np.diff(words.first).astype(np.uint64)) if count else total


def benchmark_windows(benchmark: DataFrame, window: int, gram: int) -> DataFrame:
    """Every window of every item with its fingerprints: one row per (window, fingerprint)."""

    def windows(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            out = {"item_id": [], "length": [], "fingerprint": [], "span": []}
            for low, high, data, offsets in W.text_slices(batch.column(1)):
                words = W.split_words(data, offsets, W.ALNUM, lower=True)
                whole = W.gram_values(words.values, window)
                part = W.gram_values(words.values, gram)
                for item in range(high - low):
                    first, last = words.first[item], words.first[item + 1]
                    count = last - first
                    if not count:
                        continue
                    if count < window:
                        spans = [(int(count), v, v) for v in W.gram_values(words.values[first:last], count)[:1]]
                    else:
                        spans = []
                        for at in range(first, last - window + 1):
                            near = part[at : at + window - gram + 1]
                            spans.append((window, near.min(), whole[at]))
                    for length, fingerprint, span in spans:
                        out["item_id"].append(ids[low + item])
                        out["length"].append(length)
                        out["fingerprint"].append(int(signed(np.array([fingerprint]))[0]))
                        out["span"].append(int(signed(np.array([span]))[0]))
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
                ("item_id", pa.int64()), ("length", pa.int32()),
                ("fingerprint", pa.int64()), ("span", pa.int64())]))

    rows = benchmark.select(F.col("item_id").cast("long"), "text")
    return rows.mapInArrow(windows, ITEM_SCHEMA)


def bitmap_of(windows: DataFrame) -> bytes:
    """A bit for each fingerprint's low bits; each task sends one map of fixed size."""

    def bits(batches):
        seen = np.zeros(1 << BITS, dtype=bool)
        for batch in batches:
            values = np.asarray(batch.column(0)).view(np.uint64)
            seen[(values & np.uint64((1 << BITS) - 1)).astype(np.int64)] = True
        yield pa.RecordBatch.from_pydict({"bits": [np.packbits(seen).tobytes()]})

    total = np.zeros(1 << (BITS - 3), dtype=np.uint8)
    for row in windows.select("fingerprint").mapInArrow(bits, "bits binary").toLocalIterator():
        total |= np.frombuffer(row.bits, dtype=np.uint8)
    return total.tobytes()


def document_hits(
    documents: DataFrame, window: int, gram: int, short: list[int], bitmap: bytes
) -> DataFrame:
    """A row per document, and one per fingerprint that may be one of the benchmark's."""

    def hits(batches):
        seen = np.unpackbits(np.frombuffer(bitmap, dtype=np.uint8)).astype(bool)
        passes = lambda v: seen[(v & np.uint64((1 << BITS) - 1)).astype(np.int64)]
        reach = window - gram + 1
        span_type = pa.struct([("start", pa.int32()), ("length", pa.int32()), ("span", pa.int64())])
        names = ["doc_id", "copy", "n_words", "fingerprint", "spans"]
        for batch in batches:
            for low, high, data, offsets in W.text_slices(batch.column(1)):
                words = W.split_words(data, offsets, W.ALNUM, lower=True)
                count, left = len(words.values), W.room(words)
                text, keys = W.text_of(words), text_key(words)
                begin = np.arange(count) - words.first[text]
                parts, whole = W.gram_values(words.values, gram), W.gram_values(words.values, window)
                top = np.uint64(0xFFFFFFFFFFFFFFFF)
                least = W.sliding_min(np.where(left >= gram, parts, top), reach)
                full = left >= window
                rows = []  # (word, fingerprint, start word, length, span)
                # a window stands for its least k-gram, wherever that lies within it
                found = np.flatnonzero(full & passes(least)) if count else np.zeros(0, np.int64)
                rows.append((found, least[found], whole[found], window))
                for length in short:
                    some = W.gram_values(words.values, length)
                    found = np.flatnonzero((left >= length) & passes(some)) if count else found
                    rows.append((found, some[found], some[found], length))
                place = np.concatenate([r[0] for r in rows])
                prints = np.concatenate([r[1] for r in rows])
                spans = np.concatenate([r[2] for r in rows])
                lengths = np.concatenate([np.full(len(r[0]), r[3], np.int32) for r in rows])
                # windows of one document that choose the same fingerprint travel together
                order = np.lexsort((place, prints, text[place]))
                place, prints, spans, lengths = place[order], prints[order], spans[order], lengths[order]
                fresh = np.ones(len(place), dtype=bool)
                fresh[1:] = (prints[1:] != prints[:-1]) | (text[place[1:]] != text[place[:-1]])
                heads = np.flatnonzero(fresh)
                ids = batch.column(0).slice(low, high - low).take(
                    pa.array(np.concatenate([np.arange(high - low), text[place[heads]]])))
                own = np.concatenate([keys, keys[text[place[heads]]]])
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([np.zeros(high - low, np.int64), heads, [len(place)]]).astype(np.int32)),
                    pa.StructArray.from_arrays(
                        [pa.array(begin[place].astype(np.int32)), pa.array(lengths), pa.array(signed(spans))],
                        fields=list(span_type)))
                totals = np.concatenate([np.diff(words.first), np.zeros(len(heads), np.int64)])
                marks = np.arange(len(own)) >= high - low
                yield pa.RecordBatch.from_arrays([
                    ids, pa.array(signed(own)), pa.array(totals, mask=marks),
                    pa.array(signed(np.concatenate([keys, prints[heads]]))), lists], names=names)

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(hits, HIT_SCHEMA)


def contaminated_words(
    documents: DataFrame, benchmark: DataFrame, window: int = 10, gram: int = 5
) -> DataFrame:
    """Per row of ``documents``: doc_id, n_words, n_hit, item_ids and the hit spans.

    ``hit_starts`` are (first word, length) of the windows found, in order.
    """
    test = staged(benchmark_windows(benchmark, window, gram), "decontamination-items")
    short = [r[0] for r in test.filter(F.col("length") < window).select("length").distinct().collect()]
    bitmap = bitmap_of(test)
    prints = test.select("fingerprint").distinct().withColumn("known", F.lit(True))
    spans = test.groupBy("length", "span").agg(F.collect_set("item_id").alias("items"))

    rows = document_hits(documents, window, gram, sorted(short), bitmap)
    rows = rows.join(prints, "fingerprint", "left").filter("n_words is not null or known")
    rows = rows.select("doc_id", "copy", "n_words", F.explode_outer("spans").alias("at"))
    rows = rows.select("doc_id", "copy", "n_words", "at.start", "at.length", "at.span")
    # a document's own row gets a span no item has, so that the keys of a join stay spread
    rows = rows.withColumn("span", F.coalesce("span", "copy")).withColumn(
        "length", F.coalesce("length", F.lit(0)))
    rows = rows.join(spans, ["length", "span"], "left").filter("n_words is not null or items is not null")
    found = rows.groupBy("doc_id", "copy").agg(
        F.max("n_words").alias("n_words"),
        F.count("n_words").alias("times"),
        F.array_sort(F.collect_set(F.when(F.col("items").isNotNull(), F.struct("start", "length")))).alias("hit_starts"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("item_ids"),
    )
    end = lambda s: s["start"] + s["length"]
    n_hit = F.aggregate(
        "hit_starts",
        F.struct(F.lit(0).alias("until"), F.lit(0).cast("long").alias("hit")),
        lambda a, s: F.struct(
            F.greatest(a["until"], end(s)).alias("until"),
            (a["hit"] + F.greatest(F.lit(0), end(s) - F.greatest(a["until"], s["start"]))).alias("hit"),
        ),
        lambda a: a["hit"],
    )
    # rows that repeat in every word were counted once; each gets its row back
    return found.withColumn("n_hit", n_hit).select(
        "doc_id", "n_words", "n_hit", "item_ids", "hit_starts",
        F.explode(F.array_repeat(F.lit(0), F.col("times").cast("int"))).alias("_row"),
    ).drop("_row")


def op3_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark words in every document."""
    found = contaminated_words(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    names = F.array_sort(F.transform("item_ids", lambda i: i.cast("string")))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", names).cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


TOKENS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

OP3_SQL = f"""
WITH d AS (SELECT doc_id, {TOKENS} AS w FROM documents),
b AS (SELECT item_id, {TOKENS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)),
hit AS (SELECT dw.doc_id, dw.n, dw.i, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.g = bw.g),
hw AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY 1),
hi AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)"""
