"""Removal of word passages that an earlier document already has, by level-wise doubling.

Windows are tested at a fraction of their length first.  At each level below the full
one a window is represented by the least of its word n-grams of that length, which equal
windows choose alike; only windows whose n-gram occurs in two documents are extended to
twice that length, until the full length is reached or no candidate survives.  At the
full length every surviving window is compared, so the result is exact (up to equality of
64-bit hashes).

Documents whose whole text an earlier document has are told apart first, on hashes.
Each level counts per value before it shuffles, and joins values to their least document;
no group of equal windows is ever gathered in one place.

Defined results: null and empty texts have no words and lose none; rows with a null
``doc_id`` neither lose words nor count as earlier; rows that repeat are treated alike,
and rows of one ``doc_id`` never cost each other words; a text of fewer words than the
window stays whole; carried columns that clash with result columns are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerflow.llm import words as W
from ledgerflow.llm.common import staged, table

WINDOW = 50
TOP = np.uint64(0xFFFFFFFFFFFFFFFF)
KEY = ["doc_id", "copy"]
RESULT = "doc_id long, n_words long, n_removed long, removed array<struct<start:int,end:int>>, kept_text string"


def keyed(documents: DataFrame) -> DataFrame:
    """``copy`` tells rows of one doc_id apart by their text; equal rows share their fate."""
    return documents.withColumn("doc_id", F.col("doc_id").cast("long")).withColumn(
        "copy", F.xxhash64("text"))


def whole_copies(documents: DataFrame) -> DataFrame:
    """(doc_id, copy) of the documents whose text a smaller doc_id has too."""
    narrow = keyed(documents).filter("text is not null and doc_id is not null").select(
        *KEY, F.length("text").alias("size"))
    first = narrow.groupBy("copy", "size").agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last")
    return narrow.join(first, ["copy", "size"]).filter("doc_id > first").select(*KEY).distinct()


def surviving_windows(words: W.Words, window: int, length: int, at: np.ndarray) -> np.ndarray:
    """Which words begin a window whose least n-gram stands at one of the places ``at``."""
    grams, reach = W.gram_values(words.values, length), window - length + 1
    marked = np.full(len(grams), TOP)
    marked[at] = grams[at]
    least = W.sliding_min(grams, reach)
    return (W.sliding_min(marked, reach) == least) & (W.room(words) >= window)


def chosen_grams(words: W.Words, window: int, length: int, alive: np.ndarray):
    """(places, values) of the n-grams that represent the windows that are ``alive``."""
    grams, reach = W.gram_values(words.values, length), window - length + 1
    least = np.where(alive, W.sliding_min(grams, reach), np.uint64(0))
    # the greatest "least" of the windows over a place is that of a window it represents
    over = ~W.sliding_min(~least[::-1], reach)[::-1]
    places = np.flatnonzero((over == grams) & (over > 0))
    return places, grams[places]


def places_of(batch: pa.RecordBatch, low: int, high: int, words: W.Words) -> np.ndarray:
    """The word numbers of the places that column ``at`` holds for each text of a slice."""
    lists = batch.column("at").slice(low, high - low)
    counts = np.diff(np.asarray(lists.offsets).astype(np.int64))
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64) + np.repeat(words.first[:-1], counts)


def level(documents: DataFrame, window: int, length: int, before: int | None) -> DataFrame:
    """Per document and n-gram value that represents a window: the places it stands at.

    ``place`` is the first and ``more`` holds the others, if any: a word that comes again and
    again gives a document one row, not one per place.  ``before`` is the length of the level whose survivors column ``at`` names.
    """

    def grams(batches):
        for batch in batches:
            for low, high, data, offsets in W.text_slices(batch.column("text")):
                words = W.split_words(data, offsets, W.UNBLANK)
                if not len(words.values):
                    continue
                if before is None:
                    alive = W.room(words) >= window
                else:
                    alive = surviving_windows(words, window, before, places_of(batch, low, high, words))
                if length == window:
                    places = np.flatnonzero(alive)
                    values = W.gram_values(words.values, window)[places]
                else:
                    places, values = chosen_grams(words, window, length, alive)
                text = W.text_of(words)[places]
                order = np.lexsort((values, text))  # places of one value stay in their order
                text, values = text[order], values[order]
                places = (places[order] - words.first[text]).astype(np.int32)
                first = np.ones(len(order), dtype=bool)
                first[1:] = (text[1:] != text[:-1]) | (values[1:] != values[:-1])
                heads = np.flatnonzero(first)
                others = np.diff(np.append(heads, len(order))) - 1
                more = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(others)]).astype(np.int32)),
                    pa.array(places[~first]), mask=pa.array(others == 0))
                rows = pa.array(low + text[heads])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(rows), batch.column("copy").take(rows),
                     pa.array(values[heads].view(np.int64)), pa.array(places[heads]), more],
                    names=["doc_id", "copy", "gram", "place", "more"])

    columns = ["doc_id", "copy", "text"] + ([] if before is None else ["at"])
    return documents.select(*columns).mapInArrow(
        grams, "doc_id long, copy long, gram long, place int, more array<int>")


def all_places(rows: DataFrame) -> DataFrame:
    """(doc_id, copy, at): the places of all values of a document, in order; equal rows count once."""
    own = F.concat(F.array("place"), F.coalesce("more", F.array().cast("array<int>")))
    return rows.groupBy(*KEY).agg(F.sort_array(F.flatten(F.collect_set(own))).alias("at"))


def repeated(rows: DataFrame) -> DataFrame:
    """Values that two documents have, with the least of them.

    Written before it is joined, so that both sides of the join are shuffled for it alone
    and Spark can split a value that very many rows have.
    """
    found = rows.groupBy("gram").agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last")
    return staged(found.drop("last"), "substring-repeated")


def earlier_windows(documents: DataFrame, window: int = WINDOW, first_length: int | None = None) -> DataFrame:
    """(doc_id, copy, starts): the windows of each document that an earlier one has too."""
    source = keyed(documents).filter("text is not null and doc_id is not null").select(*KEY, "text")
    length, before, rows_of = first_length or -(-window // 2), None, source
    copies = whole_copies(documents)
    while length < window:
        rows = staged(level(rows_of, window, length, before), "substring-level")
        if before is None:
            rows = rows.join(copies, KEY, "left_anti")
        alive = rows.join(repeated(rows), "gram", "left_semi")
        alive = staged(all_places(alive), "substring-alive")
        rows_of = source.join(alive, KEY)
        length, before = min(2 * length, window), length
        if alive.isEmpty():
            break
    rows = staged(level(rows_of, window, window, before), "substring-windows")
    if before is None:
        rows = rows.join(copies, KEY, "left_anti")
    later = rows.join(repeated(rows), "gram").filter("doc_id > first")
    return all_places(later)


def without_repeats(
    documents: DataFrame,
    window: int = WINDOW,
    first_length: int | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Per row: its carried columns, n_words, n_removed, the removed spans of words and the
    kept text, which is the words that stay, joined by one space."""
    marks = earlier_windows(documents, window, first_length).withColumn("whole", F.lit(False))
    marks = marks.unionByName(whole_copies(documents).select(
        *KEY, F.lit(None).cast("array<int>").alias("at"), F.lit(True).alias("whole")))
    marks = marks.select(F.col("doc_id").alias("_id"), F.col("copy").alias("_copy"), "at", "whole")
    result = StructType.fromDDL(RESULT)
    extra = [c for c in carry if c not in result.fieldNames()]
    rows = keyed(documents).select(*KEY, "text", *[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(extra)])
    rows = rows.join(marks, (F.col("doc_id") == F.col("_id")) & (F.col("copy") == F.col("_copy")), "left")
    rows = rows.drop("_id", "_copy", "copy").withColumn("at", F.coalesce("at", F.array().cast("array<int>")))

    def cut(batches):
        span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
        for batch in batches:
            for low, high, data, offsets in W.text_slices(batch.column("text")):
                words = W.split_words(data, offsets, W.UNBLANK)
                count = len(words.values)
                gone = W.covered(places_of(batch, low, high, words), window, count)
                whole = np.array(batch.column("whole").slice(low, high - low).fill_null(False))
                per_text = np.diff(words.first)
                gone |= np.repeat(whole & (per_text >= window), per_text)
                sums = np.concatenate([[0], np.cumsum(gone)])
                removed = sums[words.first[1:]] - sums[words.first[:-1]]
                # spans of removed words, broken where texts begin
                opens, shuts = gone.copy(), gone.copy()
                opens[1:] &= ~gone[:-1]
                shuts[:-1] &= ~gone[1:]
                heads = words.first[:-1][per_text > 0]
                opens[heads] = gone[heads]
                tails = words.first[1:][per_text > 0] - 1
                shuts[tails] = gone[tails]
                opens, shuts = np.flatnonzero(opens), np.flatnonzero(shuts)
                text = W.text_of(words)
                base = words.first[text[opens]]
                lists = pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(opens, words.first).astype(np.int32)),
                    pa.StructArray.from_arrays(
                        [pa.array((opens - base).astype(np.int32)), pa.array((shuts + 1 - base).astype(np.int32))],
                        fields=list(span)))
                raw, kept = data.tobytes(), []
                for t in range(high - low):
                    own = raw[offsets[t] : offsets[t + 1]].split()
                    if removed[t]:
                        left = ~gone[words.first[t] : words.first[t + 1]]
                        own = [w for w, stays in zip(own, left.tolist()) if stays]
                    kept.append(b" ".join(own))
                some = slice(low, high)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[some], pa.array(per_text.astype(np.int64)),
                     pa.array(removed.astype(np.int64)), lists, pa.array(kept, pa.binary()).cast(pa.string()),
                     *[batch.column(f"_{i}")[some] for i in range(len(extra))]],
                    names=[*result.fieldNames(), *extra])

    schema = StructType(result.fields + [documents.schema[c] for c in extra])
    return rows.mapInArrow(cut, schema)


def op7_doubling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words that an earlier document has too, taken out of every document."""
    kept = without_repeats(table(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


OP7_SQL = """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, i, md5_number_lower(array_to_string(w[i:i + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
f AS (SELECT h, min(doc_id) AS first FROM g GROUP BY 1),
r AS (SELECT DISTINCT doc_id, p FROM (
  SELECT doc_id, unnest(range(i, i + 50)) AS p FROM g JOIN f USING (h) WHERE doc_id > first)),
k AS (SELECT e.doc_id, string_agg(x, ' ' ORDER BY e.p) AS kept, count(*) AS n_kept
  FROM (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d) e
  ANTI JOIN r ON e.doc_id = r.doc_id AND e.p = r.p GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n_kept, 0))::BIGINT AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)"""
