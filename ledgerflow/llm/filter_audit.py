"""How five text filters interact: what each would remove in every order of application.

A document fails a set of the filters, its mask; only the mask, the part and the labels
matter from there on, so documents are counted per part and mask, at most 32 cells a part.
Every cell folds across the array of all 120 orders: ``aggregate`` walks the letters of an
order to the step that removes the cell, ``transform`` turns the five steps into structs
weighted by the cell's counts.  The 600 structs of a part's cells are merged by elementwise
sums.  The order array is a constant of the plan and goes to every task with it.

Which rows repeat the text of a smaller id is found by counts as well: rows are counted per
digest of the text and id, then per digest, part and labels with the least id, so a text
that a third of all rows share meets as one row for each of its parts and labels.

Defined results: a null text is empty; a null source is the part ``""``, as an empty one is;
a row without a doc_id repeats nothing and is repeated by nothing; rows of one id repeat
each other in no case and are counted each, however long their texts are; a document
labelled twice is good (toxic) if one of its labels says so; columns other than doc_id,
text and source are not looked at; an empty table has no parts and gives no rows.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm.common import staged, table

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
STEPS = len(FILTERS)
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def own_mask(text: Column) -> Column:
    """Bits 0 to 3: the filters A to D that a text fails by itself."""
    words = F.array_remove(F.split(text, "[\t-\r ]"), "")
    count, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.regexp_count(text, F.lit("[A-Z]"))
    failed = [
        count < 200,
        100 * distinct < 50 * count,
        100 * capitals > 2 * F.length(text),
        text.rlike("[#$%&*|]"),
    ]
    return sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(failed)), F.lit(0))


def cells(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents and labelled ones among them, per part and mask."""
    text = F.coalesce("text", F.lit(""))
    rows = documents.select(
        F.col("doc_id").alias("id"), F.coalesce("source", F.lit("")).alias("part"),
        own_mask(text).alias("own"), F.sha2(text, 256).alias("digest"))
    marked = labels.groupBy(F.col("doc_id").alias("id")).agg(
        F.max((F.col("quality") == 1).cast("long")).alias("good"),
        F.max((F.col("toxic") == 1).cast("long")).alias("toxic"))
    kind = ["digest", "part", "own", "good", "toxic", "named"]
    by_id = rows.join(marked, "id", "left").na.fill(0, ["good", "toxic"]).groupBy(
        "id", "digest", "part", "own", "good", "toxic").agg(F.count(F.lit(1)).alias("n"))
    # of each kind of row all, and those of its least id
    kinds = by_id.withColumn("named", F.col("id").isNotNull()).groupBy(*kind).agg(
        F.sum("n").alias("n"), F.min(F.struct("id", "n")).alias("first"))
    # read twice below, and made by a pass over all texts
    kinds = staged(kinds, "audit-kinds")
    least = kinds.filter("named").groupBy("digest").agg(F.min("first.id").alias("least"))
    passing = F.when(~F.col("named"), F.col("n")).when(
        F.col("first.id") == F.col("least"), F.col("first.n")).otherwise(0)
    split = F.explode(F.array(
        F.struct(F.lit(0).alias("repeats"), passing.alias("n")),
        F.struct(F.lit(16).alias("repeats"), (F.col("n") - passing).alias("n")),
    ))
    found = kinds.join(least, "digest", "left").select("part", "own", "good", "toxic", split.alias("half"))
    n = F.col("half.n")
    return found.filter(n > 0).groupBy("part", (F.col("own") + F.col("half.repeats")).alias("mask")).agg(
        F.sum(n).alias("n"), F.sum(n * F.col("good")).alias("good"), F.sum(n * F.col("toxic")).alias("toxic"))


def _bit(order: Column, step: Column) -> Column:
    """The mask bit of the filter at a step of an order."""
    return F.ascii(F.substring(order, step, F.lit(1))) - ord(FILTERS[0])


def _fails(mask: Column, order: Column, step: Column) -> Column:
    return F.getbit(mask, _bit(order, step)) == 1


def folded(cell: Column, orders: Column) -> Column:
    """600 structs: what every step of every order does to a cell."""
    steps = F.sequence(F.lit(1), F.lit(STEPS))
    mask, zero = cell["mask"], F.lit(0).cast("long")

    def of_order(order: Column) -> Column:
        # the step that removes the cell, 9 for none
        last = F.aggregate(steps, F.lit(9), lambda at, s: F.when(
            (at == 9) & _fails(mask, order, s), s).otherwise(at))

        def of_step(step: Column) -> Column:
            weight = lambda holds, what: F.when(holds, cell[what]).otherwise(zero)
            removed, fails = last == step, _fails(mask, order, step)
            alone = fails & (F.bit_count(mask) == 1)
            return F.struct(
                weight(last > step, "n").alias("kept"),
                weight(removed, "n").alias("removed"),
                weight(fails & (last < step), "n").alias("redundant"),
                weight(alone, "n").alias("unique_fails"),
                weight(removed, "good").alias("good_lost"),
                weight(removed, "toxic").alias("toxic_lost"),
            )

        return F.transform(steps, of_step)

    return F.flatten(F.transform(orders, of_order))


def audited(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order and step."""
    orders = F.array(*map(F.lit, ORDERS))
    zero = F.struct(*[F.lit(0).cast("long").alias(c) for c in COUNTS])
    added = lambda a, b: F.zip_with(a, b, lambda x, y: F.struct(*[(x[c] + y[c]).alias(c) for c in COUNTS]))
    # at most 32 cells of a part
    parts = cells(documents, labels).groupBy("part").agg(
        F.collect_list(F.struct(F.col("mask").cast("long").alias("mask"), "n", "good", "toxic")).alias("cells"))
    merged = F.aggregate(
        "cells", F.array_repeat(zero, STEPS * len(ORDERS)), lambda sums, cell: added(sums, folded(cell, orders)))
    rows = parts.select("part", merged.alias("sums"))
    place = F.sequence(F.lit(0), F.lit(STEPS * len(ORDERS) - 1))
    order_at = lambda i: F.element_at(orders, F.floor(i / STEPS).cast("int") + 1)
    totals = F.transform(F.sequence(F.lit(0), F.lit(STEPS - 1)), lambda bit: F.aggregate(
        place, F.lit(0).cast("long"), lambda total, i: total + F.when(
            _bit(order_at(i), i % STEPS + 1) == bit, F.element_at("sums", i + 1)["removed"]).otherwise(0)))
    found = rows.withColumn("totals", totals).select("part", "totals", F.posexplode("sums").alias("i", "at"))
    order, step = order_at(F.col("i")), F.col("i") % STEPS + 1
    return found.select(
        "part", order.alias("filter_order"), step.cast("int").alias("step"), "at.*",
        F.element_at("totals", _bit(order, step) + 1).alias("shapley"))


def op13_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of all documents, by source."""
    return audited(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP13_SQL = f"""
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
  [w for w in regexp_split_to_array(coalesce(text, ''), '[\\x09-\\x0D ]') if w <> ''] AS words FROM documents),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY 1),
m AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
  [len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words),
   100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 2 * length(text),
   regexp_matches(text, '[#$%&*|]'),
   coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)] AS fails
  FROM t LEFT JOIN l USING (doc_id)),
c AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY 1, 2),
o AS (SELECT unnest({ORDERS}) AS filter_order),
s AS (SELECT *, [fails[ascii(x) - 64] for x in string_split(filter_order, '')] AS f FROM c, o),
p AS (SELECT *, coalesce(list_position(f, true), 9) AS last FROM s),
r AS (SELECT part, filter_order, step::INTEGER AS step,
  sum(CASE WHEN last > step THEN n ELSE 0 END)::BIGINT AS kept,
  sum(CASE WHEN last = step THEN n ELSE 0 END)::BIGINT AS removed,
  sum(CASE WHEN last < step AND f[step] THEN n ELSE 0 END)::BIGINT AS redundant,
  sum(CASE WHEN f[step] AND len([x for x in f if x]) = 1 THEN n ELSE 0 END)::BIGINT AS unique_fails,
  sum(CASE WHEN last = step THEN good ELSE 0 END)::BIGINT AS good_lost,
  sum(CASE WHEN last = step THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM p, range(1, 6) g(step) GROUP BY ALL)
SELECT *, (sum(removed) OVER (PARTITION BY part, filter_order[step]))::BIGINT AS shapley FROM r"""
