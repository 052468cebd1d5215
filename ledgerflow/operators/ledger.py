"""The stored ledger: Parquet tables whose rows become visible batch by batch.

Every table is a folder of ``batch_id=.../attempt=...`` parts.  A batch first writes its
parts and last of all one marker row under ``commits`` that names the attempt; readers
only see marked attempts, so rows and progress marks appear together or not at all.
Parts are never changed: a batch that starts over writes a new attempt, and what the
old one left behind stays unseen.  A batch may replace a table: readers then see its part
and those of later batches only.

Two kinds of tables lie in buckets of a key's digest.  Invoices and attachments are added to,
and whoever looks for keys opens the buckets of those keys only; rows without a key lie in a
bucket of their own, which nobody opens for it.  Marks and processed uids are states: a batch
writes the buckets it touches anew, and its marker names for every bucket the part that
counts, so reading them does not grow with the number of batches.    Batches are told apart by text, so that writers with
names of their own never share one.  One writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from ledgerflow import schemas
from ledgerflow.operators import intervals
from ledgerflow.operators.commit import update_watermarks
from ledgerflow.operators.staging import together

OUTCOME = StructType([
    StructField("source_folder_id", LongType()),
    StructField("uid", LongType()),
    StructField("chunk_num", schemas.CHUNK_METRICS["chunk_num"].dataType),
    StructField("status", StringType()),
    StructField("error", StringType()),
    # whether the message counts as processed
    StructField("committed", BooleanType()),
    *[
        StructField(name, schemas.CHUNK_METRICS[name].dataType)
        for name in (
            "duration_sec", "classification_time_sec", "extraction_time_sec",
            "s3_upload_time_sec", "db_commit_time_sec",
        )
    ],
])

PROCESSED = StructType([StructField(n, LongType()) for n in (*intervals.KEY, "low", "high")])

TABLES = {
    "source_folder": schemas.SOURCE_FOLDER,
    "invoice": schemas.INVOICE,
    "watermark": schemas.WATERMARK,
    "attachment": schemas.ATTACHMENT,
    "chunk_metrics": schemas.CHUNK_METRICS,
    "outcome": OUTCOME,
    "processed": PROCESSED,
}
PART = StructType([
    StructField("table", StringType()),
    StructField("bucket", IntegerType()),
    StructField("batch_id", StringType()),
    StructField("attempt", StringType()),
])
COMMITS = StructType([
    StructField("attempt", StringType()),
    StructField("seq", LongType()),
    StructField("replaces", ArrayType(StringType())),
    StructField("top_id", LongType()),  # no invoice has a higher id
    StructField("parts", ArrayType(PART)),  # where each bucket of the states lies
    StructField("buckets", IntegerType()),
])
# The batch that creates the empty tables.
GENESIS = "genesis"
# States, by the key of their buckets: a batch writes the buckets it touches in full.
WHOLE = {"watermark": ("source_folder_id",), "processed": tuple(intervals.KEY)}
# Tables that grow, by the key that is looked for in them.
KEYED = {"invoice": ("invoice_number",), "attachment": ("file_key",)}
BUCKETS = 16
NO_KEY = -1

BatchId = int | str


def _nullable(schema: StructType) -> StructType:
    return StructType([StructField(f.name, f.dataType, True) for f in schema.fields])


def _empty(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows, made without Python tasks."""
    return spark.range(0, 0, 1, 1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


class Ledger:
    """Tables under one root folder on storage that all executors share."""

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self._buckets = buckets
        self._attempts: dict[str, str] = {}
        self._staged: dict[str, set[str]] = {}
        self._handed_over: dict[str, dict[str, StructType]] = {}

    @classmethod
    def create(
        cls, spark: SparkSession, root: str, folders: DataFrame | None = None, buckets: int = BUCKETS
    ) -> Ledger:
        """Start an empty ledger, or one that knows the given folders.

        The number of buckets stays: take enough that a bucket's keys fit a few tasks.
        """
        ledger = cls(spark, root, buckets)
        ledger.begin(GENESIS)
        first = {name: _empty(spark, schema) for name, schema in TABLES.items()}
        if folders is not None:
            first["source_folder"] = folders
        together(spark, *[partial(ledger.stage, name, rows, GENESIS) for name, rows in first.items()])
        ledger.commit(GENESIS)
        return ledger

    def begin(self, batch_id: BatchId) -> None:
        """Start a batch, or start it over."""
        self._attempts[str(batch_id)] = uuid.uuid4().hex
        self._staged[str(batch_id)] = set()

    @property
    def buckets(self) -> int:
        if self._buckets is None:
            self._buckets = self.newest().buckets
        return self._buckets

    def bucket(self, table: str) -> Column:
        """The bucket of a row of a table that lies in buckets."""
        key = [F.col(c) for c in {**WHOLE, **KEYED}[table]]
        missing = reduce(lambda a, b: a | b, [c.isNull() for c in key])
        place = F.pmod(F.xxhash64(*key), F.lit(self.buckets)).cast("int")
        return F.when(missing, F.lit(NO_KEY)).otherwise(place)

    def touched(self, table: str, rows: DataFrame) -> list[int]:
        """The buckets that hold the keys of some rows; there are at most ``buckets`` of them."""
        return self.touched_by(rows, table)[table]

    def touched_by(self, rows: DataFrame, *tables: str) -> dict[str, list[int]]:
        """The same for several tables, in one pass over rows that have the keys of all."""
        sets = [F.collect_set(self.bucket(t)).alias(t) for t in tables]
        found = rows.agg(*sets).first()
        return {t: sorted(b for b in found[t] if b != NO_KEY) for t in tables}

    def _part(self, table: str, batch_id: BatchId) -> str:
        if str(batch_id) not in self._attempts:
            self.begin(batch_id)
        return f"{self.root}/{table}/batch_id={batch_id}/attempt={self._attempts[str(batch_id)]}"

    def stage(self, table: str, rows: DataFrame, batch_id: BatchId) -> None:
        """Write a batch's rows of a table; nobody sees them before the commit."""
        rows = rows.select(*TABLES[table].fieldNames())
        if table in WHOLE or table in KEYED:
            # few files for each bucket, and several tasks for one that is large
            rows = rows.withColumn("bucket", self.bucket(table)).hint("rebalance", "bucket")
            rows.write.mode("overwrite").partitionBy("bucket").parquet(self._part(table, batch_id))
        else:
            rows.write.mode("overwrite").parquet(self._part(table, batch_id))
        self._staged.setdefault(str(batch_id), set()).add(table)

    def staged(self, table: str, batch_id: BatchId) -> DataFrame:
        """A batch's own staged rows, read back."""
        return self._own(table, batch_id).drop("bucket")

    def _own(self, table: str, batch_id: BatchId) -> DataFrame:
        fields = list(_nullable(TABLES[table]).fields)
        if table in WHOLE or table in KEYED:
            fields.append(StructField("bucket", IntegerType()))
        return self.spark.read.schema(StructType(fields)).parquet(self._part(table, batch_id))

    def hand_over(self, name: str, rows: DataFrame, batch_id: BatchId) -> DataFrame:
        """Write an intermediate result of a batch and return it read back.

        What a model answered or a parser produced is then computed once, also when
        executors are lost later on.
        """
        path = self._part(f"work/{name}", batch_id)
        schema = _nullable(rows.schema)
        rows.write.mode("overwrite").parquet(path)
        self._handed_over.setdefault(str(batch_id), {})[path] = schema
        return self.spark.read.schema(schema).parquet(path)

    def release(self, batch_id: BatchId) -> None:
        """Empty the intermediate results of a committed batch; nothing reads them any more."""
        together(self.spark, *[
            partial(_empty(self.spark, schema).write.mode("overwrite").parquet, path)
            for path, schema in self._handed_over.pop(str(batch_id), {}).items()
        ])

    def commit(self, batch_id: BatchId, replaces: Sequence[str] = ()) -> None:
        """Make a batch visible: the marker is its last write.

        Of the tables in ``replaces`` readers no longer see what earlier batches wrote.
        """
        name, attempt = str(batch_id), self._attempts[str(batch_id)]
        seq, top_id, parts = 0, 0, []
        if name != GENESIS:
            last = self.newest()
            seq, top_id, parts = last.seq + 1, last.top_id, last.parts
            parts = [tuple(p) for p in parts if p.table not in replaces]
        written = self._written(batch_id)
        top_id = max([top_id, *(v for table, v in written if table == "invoice")])
        new = {(table, bucket): (table, bucket, name, attempt) for table, bucket in written if table in WHOLE}
        parts = [p for p in parts if (p[0], p[1]) not in new] + list(new.values())
        row = (attempt, seq, list(replaces), top_id, parts, self.buckets)
        marker = self.spark.createDataFrame([row], COMMITS)
        marker.coalesce(1).write.mode("overwrite").parquet(
            f"{self.root}/commits/batch_id={batch_id}"
        )

    def _written(self, batch_id: BatchId) -> list[tuple[str, int]]:
        """The buckets of the states that a batch wrote, and its highest invoice id."""
        tables = self._staged.get(str(batch_id), set())
        found = [
            self._own(t, batch_id).select(F.lit(t).alias("table"), F.col("bucket").cast("long").alias("v")).distinct()
            for t in WHOLE if t in tables
        ]
        if "invoice" in tables:
            highest = self._own("invoice", batch_id).agg(F.max("id").alias("v"))
            found.append(highest.filter("v is not null").select(F.lit("invoice").alias("table"), "v"))
        return [tuple(r) for r in reduce(DataFrame.unionAll, found).collect()] if found else []

    def newest(self) -> Row:
        """The marker of the last batch."""
        return self.committed().orderBy(F.desc("seq")).first()

    def committed(self) -> DataFrame:
        """Committed batches, one marker each."""
        schema = StructType([*COMMITS.fields, StructField("batch_id", StringType())])
        return self.spark.read.schema(schema).parquet(f"{self.root}/commits")

    def is_committed(self, batch_id: BatchId) -> bool:
        return not self.committed().filter(F.col("batch_id") == str(batch_id)).isEmpty()

    def visible(self, table: str) -> DataFrame:
        """Batches whose rows of a table count: the last that replaced it, and all later ones."""
        commits = self.committed()
        since = commits.filter(F.array_contains("replaces", table)).agg(
            F.coalesce(F.max("seq"), F.lit(0)))
        return commits.filter(F.col("seq") >= since.scalar()).select("batch_id", "attempt")

    def replace(self, batch_id: BatchId, tables: dict[str, DataFrame]) -> None:
        """Put new contents in place of whole tables, all of them at once."""
        if self.is_committed(batch_id):
            return
        self.begin(batch_id)
        for name, rows in tables.items():
            self.stage(name, rows, batch_id)
        self.commit(batch_id, list(tables))

    def read(
        self, table: str, with_batch: bool = False, buckets: Sequence[int] | None = None
    ) -> DataFrame:
        """Rows of all visible batches, of some buckets only where they are named."""
        if table in WHOLE:
            return self._read_state(table, buckets)
        fields = [*_nullable(TABLES[table]).fields, StructField("batch_id", StringType()),
                  StructField("attempt", StringType())]
        if table in KEYED:
            fields.append(StructField("bucket", IntegerType()))
        rows = self.spark.read.schema(StructType(fields)).parquet(f"{self.root}/{table}")
        if buckets is not None:
            rows = rows.filter(F.col("bucket").isin(list(buckets)))
        rows = rows.join(
            self.visible(table), ["batch_id", "attempt"], "left_semi").drop("attempt", "bucket")
        return rows if with_batch else rows.drop("batch_id")

    def _read_state(self, table: str, buckets: Sequence[int] | None) -> DataFrame:
        schema = _nullable(TABLES[table])
        paths = [
            f"{self.root}/{table}/batch_id={p.batch_id}/attempt={p.attempt}/bucket={p.bucket}"
            for p in self.newest().parts
            if p.table == table and (buckets is None or p.bucket in buckets)
        ]
        if not paths:
            return _empty(self.spark, schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def marks(self) -> DataFrame:
        """Latest marks of every folder that was ever processed."""
        return self.read("watermark")

    def moved_marks(self, moved: DataFrame, buckets: Sequence[int] | None = None) -> DataFrame:
        """The marks of all buckets that ``moved`` touches, those in it taken outward.

        A folder may come twice in ``moved``, from its messages and from an empty span.
        ``buckets`` are those of the folders in ``moved``, where the caller knows them.
        """
        if buckets is None:
            buckets = self.touched("watermark", moved)
        kept = self.read("watermark", buckets=buckets)
        return kept.unionByName(moved).groupBy("source_folder_id").agg(
            F.max("high_water_mark").alias("high_water_mark"),
            F.min("low_water_mark").alias("low_water_mark"),
            F.max("processed_at").alias("processed_at"),
        )

    def intervals(self, messages: DataFrame | None = None) -> DataFrame:
        """What committed batches processed, as runs of uids; of the spans some messages lie in."""
        if messages is None:
            return self.read("processed")
        keys = messages.select("source_folder_id", intervals.span_of("uid").alias("span"))
        return self.read("processed", buckets=self.touched("processed", keys))

    def more_processed(
        self, messages: DataFrame, buckets: Sequence[int] | None = None
    ) -> DataFrame:
        """The runs of all buckets that some messages touch, with these messages in them."""
        new = intervals.islands(messages)
        if buckets is None:
            buckets = self.touched("processed", new)
        kept = self.read("processed", buckets=buckets)
        return intervals.merged(kept.unionByName(new))

    def folders(self) -> DataFrame:
        """The folder table with its current marks."""
        marks = self.marks()
        return update_watermarks(self.read("source_folder"), marks, F.col("processed_at"))

    def processed(self) -> DataFrame:
        """``(source_folder_id, uid)`` of the messages that committed batches processed.

        A report over all outcomes; ``intervals`` tells the same without reading them.
        """
        return self.read("outcome").filter("committed").select("source_folder_id", "uid")

    def state(self) -> DataFrame:
        """``(source_folder_id, high_water_mark, low_water_mark)`` of every folder."""
        return self.folders().select(
            F.col("id").alias("source_folder_id"), "high_water_mark", "low_water_mark"
        )
