"""Sets of uids as runs, so that what was processed takes no row per message.

A run is ``(source_folder_id, span, low, high)``: all uids from ``low`` to ``high``.  Runs
never cross the border of a span of ``SPAN`` uids, which makes the span a key to join by,
bounds every group and spreads a folder that holds a third of all mail.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPAN = 4096
KEY = ["source_folder_id", "span"]


def span_of(uid: Column | str) -> Column:
    return F.floor((F.col(uid) if isinstance(uid, str) else uid) / SPAN).cast("long")


def islands(messages: DataFrame) -> DataFrame:
    """The runs that a set of messages forms; a message that comes twice counts once."""
    uids = messages.select("source_folder_id", "uid").distinct().withColumn("span", span_of("uid"))
    # within a run, uid and rank grow alike
    place = F.col("uid") - F.row_number().over(Window.partitionBy(*KEY).orderBy("uid"))
    return (
        uids.withColumn("_run", place).groupBy(*KEY, "_run")
        .agg(F.min("uid").alias("low"), F.max("uid").alias("high")).drop("_run")
    )


def merged(runs: DataFrame) -> DataFrame:
    """The same set in as few runs as it takes; runs may overlap or touch."""
    before = Window.partitionBy(*KEY).orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1)
    until = Window.partitionBy(*KEY).orderBy("low", "high").rowsBetween(Window.unboundedPreceding, 0)
    begins = F.coalesce(F.col("low") > F.max("high").over(before) + 1, F.lit(True)).cast("int")
    return (
        runs.select(*KEY, "low", "high").withColumn("_begins", begins)
        .withColumn("_run", F.sum("_begins").over(until))
        .groupBy(*KEY, "_run").agg(F.min("low").alias("low"), F.max("high").alias("high")).drop("_run")
    )


def remaining(messages: DataFrame, runs: DataFrame) -> DataFrame:
    """The messages whose uid lies in no run."""
    taken = runs.select(*[F.col(c).alias(f"_{c}") for c in (*KEY, "low", "high")])
    rows = messages.withColumn("_at", span_of("uid"))
    inside = (
        (F.col("source_folder_id") == F.col("_source_folder_id")) & (F.col("_at") == F.col("_span"))
        & F.col("uid").between(F.col("_low"), F.col("_high"))
    )
    return rows.join(taken, inside, "left_anti").drop("_at")


def holes(runs: DataFrame) -> DataFrame:
    """``(source_folder_id, low, high)`` of the uids between the first and last run of a folder
    that are in none; a folder's runs, not its messages, are ordered for it."""
    order = Window.partitionBy("source_folder_id").orderBy("low")
    return (
        runs.withColumn("_next", F.lead("low").over(order))
        .filter(F.col("_next") > F.col("high") + 1)
        .select("source_folder_id", (F.col("high") + 1).alias("low"), (F.col("_next") - 1).alias("high"))
    )
