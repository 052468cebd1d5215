"""Columns that are computed once, and jobs that run side by side."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def staged(rows: DataFrame, **columns: Column) -> DataFrame:
    """Add (or replace) columns that later steps read instead of computing them again.

    A plain projection is folded into whatever refers to it, filters included, so a
    chain of expressions that each use the one before several times would grow without
    end.  The one-row ``inline`` is a step the optimizer does not fold, and it stays
    within generated code.
    """
    kept = [F.col(f"`{name}`") for name in rows.columns if name not in columns]
    made = F.struct(*[value.alias(name) for name, value in columns.items()])
    return rows.select(*kept, F.inline(F.array(made)))


def together(spark: SparkSession, *steps: Callable[[], None]) -> None:
    """Run steps that do not need each other, each from a driver thread of its own.

    A small job is mostly planned, and Spark plans one job a thread.  All steps have ended
    when this returns; the first that failed is raised.
    """
    if not steps:
        return
    with ThreadPoolExecutor(len(steps)) as pool:
        # each thread gets a copy of this one's job properties
        begun = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    for step in begun:
        step.result()
