"""Raw mail laid out so that a fetch opens only files with selected mail.

A Parquet table in directories by ``place`` and, within each, in buckets by ``(folder, uid)``.
A place is one arrival of mail and one band of uids: a run over new mail finds it in the
last arrivals, a backfill in the bands of its folders.  Buckets split every folder alike, so
no folder is one task's work, and a join by folder and uid moves the selection to the bytes
instead of the bytes to the selection.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ledgerflow.sources.messages import MESSAGE_TABLE, message_keys

KEY = ["source_folder_id", "uid"]
# uids of one folder that share a band
BAND = 4096


@dataclass(frozen=True)
class MailLayout:
    """The table of one folder of raw mail, known to this session by ``name``.

    ``bands`` and ``buckets`` are fixed when the layout is made.  With fewer buckets than
    ``spark.sql.shuffle.partitions`` Spark may prefer to shuffle the bytes after all.
    """

    spark: SparkSession
    name: str
    path: str
    bands: int
    buckets: int
    condition: Column | None = None

    @classmethod
    def at(
        cls, spark: SparkSession, path: str, bands: int = 64, buckets: int | None = None
    ) -> MailLayout:
        """Make the layout at a path, or take up what lies there (under the same two numbers)."""
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        # no rows: makes the folder where there is none
        spark.createDataFrame([], MESSAGE_TABLE).withColumn("place", F.lit(0).cast("bigint")).write.mode(
            "append").partitionBy("place").parquet(path)
        name = f"mail_{uuid.uuid4().hex}"
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in MESSAGE_TABLE.fields)
        where = path.replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {name} ({columns}, place BIGINT) USING parquet "
            # an arrival overwrites its own places only
            "OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY (place) "
            f"CLUSTERED BY (source_folder_id, uid) SORTED BY (source_folder_id, uid) "
            f"INTO {buckets} BUCKETS LOCATION '{where}'"
        )
        layout = cls(spark, name, path, bands, buckets)
        layout.refresh()
        return layout

    def refresh(self) -> None:
        """Take note of arrivals that others have written."""
        self.spark.sql(f"MSCK REPAIR TABLE {self.name}")

    def place(self, arrival: int | Column) -> Column:
        """Where a message of an arrival lies."""
        band = F.pmod(F.xxhash64("source_folder_id", F.floor(F.col("uid") / BAND)), F.lit(self.bands))
        return (F.lit(arrival) * self.bands + band).cast(LongType())

    def append(self, messages: DataFrame, arrival: int) -> None:
        """Write one arrival; the same arrival written again, whole, replaces itself.

        Arrivals count from 0, and a message comes with one of them.
        """
        size = (F.col("size_bytes") if "size_bytes" in messages.columns
                else F.octet_length("rfc822_data").cast("bigint"))
        rows = messages.select(*KEY, "rfc822_data", size.alias("size_bytes"))
        # one task per bucket, so one file per place and bucket
        (
            rows.withColumn("place", self.place(arrival))
            .repartition(self.buckets, *KEY)
            .write.mode("overwrite").insertInto(self.name)
        )

    def messages(self) -> DataFrame:
        """The message table, as every connector gives it, with the place."""
        rows = self.spark.table(self.name)
        return rows if self.condition is None else rows.filter(self.condition)

    def filter(self, condition: Column) -> MailLayout:
        """The same layout, of which only some mail is seen."""
        both = condition if self.condition is None else self.condition & condition
        return replace(self, condition=both)

    def keys(self) -> DataFrame:
        """``message_keys`` of all mail; no bytes are read."""
        return message_keys(self.messages())

    def touched(self, selection: DataFrame) -> list[int]:
        """The places that hold selected mail.

        They are no more than the directories, which Spark lists on the driver anyway.
        """
        found = self.messages().select(*KEY, "place").join(
            selection.select(*KEY), KEY, "left_semi").select("place").distinct()
        return sorted(row.place for row in found.collect())

    def fetch(self, selection: DataFrame) -> DataFrame:
        """Selected messages with their bytes, from the places that hold any.

        The selection is read twice, so it should be a written one.
        """
        places = self.touched(selection)
        held = self.messages().filter(F.col("place").isin(places))
        return held.drop("place").join(selection, KEY)
