"""Mailboxes as a Spark data source, in batch and as a stream.

A mailbox client implements the three methods of ``MailConnector``; a subclass of
``ConnectorSource`` that makes one turns it into a source for ``spark.read`` and
``spark.readStream``.  Every task opens a client of its own and fetches spans of uids of at
most ``uids_per_partition`` (an option): a large folder is many tasks, small ones share one.
A client that knows how many messages a span holds says so in ``list_spans``; a task is then
that many messages, however far apart their uids lie.  Conditions on folder and uid reach the
spans, so nothing else is fetched.

``CapturedSource`` reads mail captured as Parquet, by the rows' folder and uid.
"""

from __future__ import annotations

import re
import uuid
from abc import ABC, abstractmethod
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)

FOLDER, UID = ("source_folder_id",), ("uid",)
UIDS_PER_PARTITION = 50_000
# a stream's offset holds one number per folder, some 15 bytes each
STREAM_FOLDERS = 1_000_000
# messages in one file of a capture at most; so many a row of its index speaks of
CAPTURED_ROWS = 20_000


class MailConnector(ABC):
    """A client of a mail store."""

    @abstractmethod
    def list_folders(self) -> Iterable[tuple[int, int, int]]:
        """``(folder id, least uid, greatest uid)`` of every folder that holds mail."""

    @abstractmethod
    def fetch(self, folder: int, first: int, last: int) -> Iterator[tuple[int, bytes | None]]:
        """``(uid, raw bytes)`` of a span of uids, ends included; None where a fetch failed."""

    def list_spans(self) -> Iterable[tuple[int, int, int, int]]:
        """``(folder id, least uid, greatest uid, number of messages at most)`` of spans that
        hold all mail between them; a folder may come in several, which may overlap."""
        return [(folder, first, last, last - first + 1) for folder, first, last in self.list_folders()]

    def fetch_spans(self, spans: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, bytes | None]]:
        """``(folder id, uid, raw bytes)`` of sorted spans that do not overlap."""
        for folder, first, last in spans:
            for uid, raw in self.fetch(folder, first, last):
                yield folder, uid, raw

    def close(self) -> None:
        """Let go of the connection."""


@dataclass
class Spans(InputPartition):
    """What one task fetches: spans of uids, ends included, each of one folder."""

    spans: list[tuple[int, int, int]]


def disjoint(spans: Iterable[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Sorted spans in which those that overlap are one."""
    found: list[tuple[int, int, int, int]] = []
    for folder, first, last, count in sorted(spans):
        if found and found[-1][0] == folder and first <= found[-1][2]:
            _, begin, end, before = found[-1]
            found[-1] = (folder, begin, max(end, last), before + count)
        else:
            found.append((folder, first, last, count))
    return found


def cut(spans: Iterable[tuple[int, ...]], most: int) -> list[Spans]:
    """Deal spans over tasks, each of at most ``most`` messages.

    A span that does not say how many it holds counts one a uid; one that is cut is taken to
    hold its messages evenly.
    """
    tasks: list[Spans] = []
    room = 0
    for folder, first, last, *counted in sorted(spans):
        width = last - first + 1
        left = max(min(counted[0], width), 1) if counted else width
        while first <= last:
            if not room:
                tasks.append(Spans([]))
                room = most
            taken = min(left, room)
            width = last - first + 1
            end = last if taken == left else min(last, first + max(width * taken // left, 1) - 1)
            tasks[-1].spans.append((folder, first, end))
            room -= taken
            left = max(left - taken, 1)
            first = end + 1
    return tasks


class _Reading:
    """What batch and stream have in common."""

    def __init__(self, source: ConnectorSource):
        self.source = source
        self.most = int(source.options.get("uids_per_partition", UIDS_PER_PARTITION))
        if self.most < 1:
            raise ValueError("uids_per_partition must be 1 or more")

    def listed(self) -> list[tuple[int, int, int, int]]:
        client = self.source.connect()
        try:
            return disjoint((int(f), int(a), int(b), int(n)) for f, a, b, n in client.list_spans())
        finally:
            client.close()

    def dealt(self, spans: Iterable[tuple[tuple[int, int, int, int], int, int]]) -> list[Spans]:
        """Tasks over listed spans, each cut to its lowest and highest wanted uid."""
        kept = []
        for (folder, first, last, count), low, high in spans:
            low, high = max(low, first), min(high, last)
            if low <= high:
                # its share of the messages, rounded up
                kept.append((folder, low, high, -(-count * (high - low + 1) // (last - first + 1))))
        # Spark asks for at least one task
        return cut(kept, self.most) or [Spans([])]

    def read(self, partition: Spans) -> Iterator[tuple]:
        client = self.source.connect()
        try:
            for folder, uid, raw in client.fetch_spans(partition.spans):
                yield folder, uid, raw, None if raw is None else len(raw)
        finally:
            client.close()


class ConnectorReader(_Reading, DataSourceReader):
    """A batch: all mail within the pushed conditions."""

    def __init__(self, source: ConnectorSource):
        super().__init__(source)
        self.folders: set[int] | None = None
        # least and greatest value of either column
        self.bounds: dict[tuple, list[int | None]] = {FOLDER: [None, None], UID: [None, None]}

    def pushFilters(self, filters):
        for condition in filters:
            if not self._take(condition):
                yield condition

    def _take(self, condition) -> bool:
        column, value = getattr(condition, "attribute", None), getattr(condition, "value", None)
        if column not in self.bounds:
            return False
        if isinstance(condition, In) and column == FOLDER:
            wanted = {v for v in value if v is not None}
            self.folders = wanted if self.folders is None else self.folders & wanted
            return True
        if not isinstance(value, int):
            return False
        if isinstance(condition, EqualTo):
            self._narrow(column, value, value)
        elif isinstance(condition, GreaterThan):
            self._narrow(column, value + 1, None)
        elif isinstance(condition, GreaterThanOrEqual):
            self._narrow(column, value, None)
        elif isinstance(condition, LessThan):
            self._narrow(column, None, value - 1)
        elif isinstance(condition, LessThanOrEqual):
            self._narrow(column, None, value)
        else:
            return False
        return True

    def _narrow(self, column: tuple, low: int | None, high: int | None) -> None:
        bounds = self.bounds[column]
        if low is not None:
            bounds[0] = low if bounds[0] is None else max(bounds[0], low)
        if high is not None:
            bounds[1] = high if bounds[1] is None else min(bounds[1], high)

    def _within(self, column: tuple, low: int, high: int) -> tuple[int, int]:
        least, most = self.bounds[column]
        return (low if least is None else max(low, least), high if most is None else min(high, most))

    def partitions(self) -> list[Spans]:
        spans = []
        for span in self.listed():
            folder, first, last, _ = span
            low, high = self._within(FOLDER, folder, folder)
            if low <= high and (self.folders is None or folder in self.folders):
                spans.append((span, *self._within(UID, first, last)))
        return self.dealt(spans)


class ConnectorStream(_Reading, DataSourceStreamReader):
    """A stream of the uids above those read; within a folder, uids only grow.

    The offset names the greatest uid read of every folder, so one stream takes a bounded
    number of folders (``STREAM_FOLDERS``); more are an error, and belong to more streams.
    """

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        latest: dict[str, int] = {}
        for folder, _, last, _ in self.listed():
            latest[str(folder)] = max(last, latest.get(str(folder), last))
        if len(latest) > STREAM_FOLDERS:
            raise ValueError(f"{len(latest)} folders in one stream, more than {STREAM_FOLDERS}")
        return latest

    def partitions(self, start: dict, end: dict) -> list[Spans]:
        spans = []
        for span in self.listed():
            folder = str(span[0])
            if folder in end:
                spans.append((span, max(start.get(folder, 0) + 1, 1), end[folder]))
        return self.dealt(spans)

    def commit(self, end: dict) -> None:
        """Nothing is kept outside the checkpoint."""


class ConnectorSource(DataSource):
    """A data source over a connector; subclasses name it and say how to connect."""

    def connect(self) -> MailConnector:
        raise NotImplementedError

    def schema(self) -> str:
        return "source_folder_id bigint, uid bigint, rfc822_data binary, size_bytes bigint"

    def reader(self, schema) -> ConnectorReader:
        return ConnectorReader(self)

    def streamReader(self, schema) -> ConnectorStream:
        return ConnectorStream(self)


class CapturedMail(MailConnector):
    """Mail captured by ``capture``, in a file system that Arrow can open."""

    def __init__(self, path: str):
        self.path = path

    def _open(self):
        from pyarrow.fs import FileSystem

        # Hadoop writes file:/a, Arrow reads file:///a
        return FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", self.path))

    def _index(self, columns: list[str], folders: tuple[int, int] | None = None):
        """The index of all files, or its rows of some folders from the least to the greatest."""
        import pyarrow.compute as pc
        import pyarrow.dataset as ds

        files, path = self._open()
        wanted = None if folders is None else (
            (pc.field("source_folder_id") >= folders[0]) & (pc.field("source_folder_id") <= folders[1]))
        rows = ds.dataset(f"{path}/folders", filesystem=files, format="parquet")
        table = rows.to_table(columns=columns, filter=wanted)
        return zip(*[table.column(c).to_pylist() for c in columns])

    def list_spans(self) -> Iterable[tuple[int, int, int, int]]:
        return self._index(["source_folder_id", "first_uid", "last_uid", "messages"])

    def list_folders(self) -> Iterable[tuple[int, int, int]]:
        spans: dict[int, tuple[int, int]] = {}
        for folder, first, last, _ in self.list_spans():
            low, high = spans.get(folder, (first, last))
            spans[folder] = (min(low, first), max(high, last))
        return [(folder, *span) for folder, span in spans.items()]

    def fetch(self, folder: int, first: int, last: int) -> Iterator[tuple[int, bytes | None]]:
        return ((uid, raw) for _, uid, raw in self.fetch_spans([(folder, first, last)]))

    def fetch_spans(self, spans: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, bytes | None]]:
        """One pass over the files that hold any of the spans, whatever their number."""
        import pyarrow.compute as pc
        import pyarrow.dataset as ds

        if not spans:
            return
        wanted: dict[int, tuple[list[int], list[int]]] = {}
        for folder, first, last in spans:
            firsts, lasts = wanted.setdefault(folder, ([], []))
            firsts.append(first)
            lasts.append(last)
        least, most = min(wanted), max(wanted)
        names = set()
        for folder, first, last, name in self._index(
                ["source_folder_id", "first_uid", "last_uid", "file"], (least, most)):
            if folder in wanted:
                firsts, lasts = wanted[folder]
                at = bisect_right(firsts, last) - 1
                if at >= 0 and first <= lasts[at]:
                    names.add(name)
        if not names:
            return
        # the lowest and highest uid of one folder reach the files; of several, their folders
        within = (pc.field("source_folder_id") >= least) & (pc.field("source_folder_id") <= most)
        if least == most:
            within &= (pc.field("uid") >= spans[0][1]) & (pc.field("uid") <= spans[-1][2])
        files, path = self._open()
        mail = ds.dataset([f"{path}/mail/{name}" for name in sorted(names)], filesystem=files, format="parquet")
        for batch in mail.to_batches(
                columns=["source_folder_id", "uid", "rfc822_data"], filter=within, batch_size=1024,
                batch_readahead=2, fragment_readahead=1):
            for folder, uid, raw in zip(*[batch[i].to_pylist() for i in range(3)]):
                if folder in wanted and uid is not None:
                    firsts, lasts = wanted[folder]
                    at = bisect_right(firsts, uid) - 1
                    if at >= 0 and uid <= lasts[at]:
                        yield folder, uid, raw


class CapturedSource(ConnectorSource):
    """``spark.read.format("captured_mail").option("path", ...)``."""

    @classmethod
    def name(cls) -> str:
        return "captured_mail"

    def connect(self) -> MailConnector:
        return CapturedMail(self.options["path"])


def capture(messages: DataFrame, path: str) -> None:
    """Add messages to a capture; its index comes after the mail it speaks of.

    Files are dealt and sorted by folder and uid, so that a span lies in few of them.  The
    index tells of each file which uids of which folders it holds, and how many.
    """
    key = ["source_folder_id", "uid"]
    rows = messages.select(*key, "rfc822_data").repartitionByRange(*key).sortWithinPartitions(*key)
    part = uuid.uuid4().hex
    rows.write.option("maxRecordsPerFile", CAPTURED_ROWS).parquet(f"{path}/mail/{part}")
    held = messages.sparkSession.read.schema(messages.select(*key).schema).parquet(f"{path}/mail/{part}")
    name = F.concat(F.lit(f"{part}/"), F.element_at(F.split("_metadata.file_path", "/"), -1))
    # a message without uid cannot be asked for
    index = held.select(*key, name.alias("file")).filter("uid is not null").groupBy("source_folder_id", "file").agg(
        F.min("uid").alias("first_uid"), F.max("uid").alias("last_uid"), F.count("uid").alias("messages"))
    index.write.mode("append").parquet(f"{path}/folders")
