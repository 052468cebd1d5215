"""Captured mailbox listings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def parse_folder_listing(lines: DataFrame) -> DataFrame:
    """``(source_id, list_line, status_line)`` to ``(source_id, name, uid_validity)``.

    A listing line without a quoted name after the delimiter is dropped, and so is
    a folder whose status could not be read or names no validity number.
    """
    parts = F.split("list_line", '" "')
    after_label = F.get(F.split("status_line", "UIDVALIDITY "), F.lit(1))
    return (
        lines.filter(F.size(parts) >= 2)
        .select(
            "source_id",
            F.btrim(F.element_at(parts, -1), F.lit('"')).alias("name"),
            F.get(F.split(after_label, r"\)"), F.lit(0)).alias("uid_validity"),
        )
        .filter(F.col("uid_validity").isNotNull())
    )
