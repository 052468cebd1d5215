"""Audits, gaps and referential deletes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow import schemas
from ledgerflow.operators.joins import lookup_join

# --- fixed values -----------------------------------------------------------
# Declared rules of the four tables.
REQUIRED = {
    "user": [f.name for f in schemas.USER.fields if not f.nullable],
    "source": [f.name for f in schemas.SOURCE.fields if not f.nullable],
    "source_folder": [f.name for f in schemas.SOURCE_FOLDER.fields if not f.nullable],
    "invoice": [f.name for f in schemas.INVOICE.fields if not f.nullable],
}
UNIQUE = [
    ("user", "id"),
    ("source", "id"),
    ("source_folder", "id"),
    ("invoice", "id"),
    ("invoice", "invoice_number"),
    ("user", "email"),
]
FOREIGN = [
    ("invoice", "source_folder_id", "source_folder"),
    ("invoice", "source_id", "source"),
    ("invoice", "user_id", "user"),
    ("source_folder", "source_id", "source"),
    ("source", "user_id", "user"),
]
# ----------------------------------------------------------------------------


def null_violations(name: str, table: DataFrame) -> DataFrame:
    """NULLs in required columns, all counted in one pass over the table."""
    columns = REQUIRED[name]
    counts = table.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    entries = F.array(*[
        F.struct(F.lit(f"not_null:{name}.{c}").alias("rule"), F.col(c).alias("n"))
        for c in columns
    ])
    return counts.select(F.explode(entries).alias("e")).select("e.*")


def unique_violations(name: str, column: str, table: DataFrame) -> DataFrame:
    """Rows beyond the first of each value; NULLs do not count."""
    return (
        table.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("rows"))
        .agg(F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias("n"))
        .select(F.lit(f"unique:{name}.{column}").alias("rule"), "n")
    )


def foreign_violations(
    name: str, column: str, table: DataFrame, parent_name: str, parent: DataFrame
) -> DataFrame:
    """Rows that point to a parent that is not there.

    Rows are counted per value before the join, so a value that most rows share is
    one row of it.
    """
    return (
        table.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("rows"))
        .join(parent.select(F.col("id").alias(column)), column, "left_anti")
        .agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n"))
        .select(F.lit(f"foreign:{name}.{column}->{parent_name}").alias("rule"), "n")
    )


def constraint_audit(tables: dict[str, DataFrame]) -> DataFrame:
    """``(rule, n)``: how many rows break each declared rule, zero included."""
    parts = [null_violations(name, tables[name]) for name in REQUIRED]
    parts += [unique_violations(name, column, tables[name]) for name, column in UNIQUE]
    parts += [
        foreign_violations(name, column, tables[name], parent, tables[parent])
        for name, column, parent in FOREIGN
    ]
    return reduce(DataFrame.unionByName, parts)


def _without(rows: DataFrame, column: str, gone: DataFrame) -> DataFrame:
    return lookup_join(
        rows, gone.select(F.col("id").alias(column)), [column], how="left_anti"
    )


def _set_null(rows: DataFrame, column: str, gone: DataFrame) -> DataFrame:
    marked = gone.select(F.col("id").alias(column), F.lit(True).alias("_gone"))
    joined = lookup_join(rows, marked, [column], how="left")
    return joined.withColumn(
        column, F.when(F.col("_gone").isNull(), F.col(column))
    ).select(*rows.columns)


def delete_sources(tables: dict[str, DataFrame], gone: DataFrame) -> dict[str, DataFrame]:
    """Tables after deleting the sources in ``gone`` (``id``, distinct).

    Their folders go with them; invoices stay and lose the reference to source and folder.
    """
    folders = tables["source_folder"]
    gone_folders = lookup_join(
        folders, gone.select(F.col("id").alias("source_id")), ["source_id"],
        how="left_semi",
    ).select("id")
    invoices = _set_null(tables["invoice"], "source_id", gone)
    return {
        **tables,
        "source": tables["source"].join(gone.select("id"), "id", "left_anti"),
        "source_folder": _without(folders, "source_id", gone),
        "invoice": _set_null(invoices, "source_folder_id", gone_folders),
    }


def delete_users(tables: dict[str, DataFrame], gone: DataFrame) -> dict[str, DataFrame]:
    """Tables after deleting the users in ``gone`` (``id``, distinct).

    Their sources and invoices go with them, and the sources' folders in turn.
    """
    gone_sources = lookup_join(
        tables["source"], gone.select(F.col("id").alias("user_id")), ["user_id"],
        how="left_semi",
    ).select("id")
    remaining = delete_sources(tables, gone_sources)
    return {
        **remaining,
        "user": tables["user"].join(gone.select("id"), "id", "left_anti"),
        "invoice": _without(remaining["invoice"], "user_id", gone),
    }


def unprocessed_gaps(messages: DataFrame, state: DataFrame, processed: DataFrame) -> DataFrame:
    """Messages between the marks of their folder that no run has processed.

    They arise when more new messages arrived than one batch takes, or when a chunk
    failed between successful ones; no later run selects them by itself.
    """
    marks = state.select("source_folder_id", "high_water_mark", "low_water_mark")
    inside = lookup_join(messages, marks, ["source_folder_id"]).filter(
        F.col("uid").between(F.col("low_water_mark"), F.col("high_water_mark"))
    )
    done = processed.select("source_folder_id", "uid")
    return inside.select("source_folder_id", "uid").join(
        done, ["source_folder_id", "uid"], "left_anti"
    )
