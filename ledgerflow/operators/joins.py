"""Lookup joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 16


def lookup_join(facts: DataFrame, lookup: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join many facts to a lookup table whose keys are unique.

    One key may hold a third of the facts.  Both sides are shuffled for this join alone,
    so Spark's adaptive skew join splits such a key; where its size check finds the
    lookup side small enough it is broadcast instead.  Nothing is copied for it.
    """
    return facts.join(lookup, on, how)


def salted_join(
    facts: DataFrame, lookup: DataFrame, on: list[str], spread_by: list[str | Column]
) -> DataFrame:
    """A lookup join that leaves the rows of a key spread over partitions.

    For what goes on by finer groups than the key: after a plain join all of a key's rows
    would lie in one partition, which Spark takes to be good enough for the finer groups.
    Every lookup row exists once per salt, so the lookup side is for narrow rows only.  Spark's
    size check does not see the copies and would broadcast them all, hence the hint.
    """
    dealt = facts.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(SALTS)).cast("int"))
    copies = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return dealt.join(copies.hint("merge"), [*on, "_salt"]).drop("_salt")
