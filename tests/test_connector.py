"""The mailbox data source: spans, pushed conditions, streams."""

import os
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNotNull, LessThanOrEqual

from ledgerflow.sources import connector as cn
from ledgerflow.sources.messages import read_connector, stream_connector

# executors have no copy of this module
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "source_folder_id bigint, uid bigint, rfc822_data binary"


class Noted(cn.MailConnector):
    """Two folders; every fetch leaves a file that tells its span."""

    def __init__(self, path):
        self.path = path

    def list_folders(self):
        return [(1, 1, 10), (2, 5, 6)]

    def fetch(self, folder, first, last):
        open(f"{self.path}/{folder}-{first}-{last}", "w").close()
        return ((uid, None if uid == 6 else b"x" * uid) for uid in range(first, last + 1))


class NotedSource(cn.ConnectorSource):
    @classmethod
    def name(cls):
        return "noted_mail"

    def connect(self):
        return Noted(self.options["path"])


def mail(spark, pairs):
    return spark.createDataFrame([(f, u, f"{f}/{u}".encode()) for f, u in pairs], SCHEMA)


@pytest.mark.parametrize("most, expected", [
    (100, [[(1, 1, 10), (2, 5, 6)]]),
    (11, [[(1, 1, 10), (2, 5, 5)], [(2, 6, 6)]]),
    (5, [[(1, 1, 5)], [(1, 6, 10)], [(2, 5, 6)]]),
])
def test_large_folders_are_cut_and_small_ones_joined(most, expected):
    assert [task.spans for task in cn.cut([(2, 5, 6), (1, 1, 10), (3, 2, 1)], most)] == expected


def test_conditions_reach_the_spans(tmp_path):
    reader = NotedSource({"path": str(tmp_path)}).reader(None)
    left = [IsNotNull(("uid",)), EqualTo(("rfc822_data",), b"x")]
    pushed = [In(("source_folder_id",), (1, 9)), GreaterThan(("uid",), 2), LessThanOrEqual(("uid",), 4)]
    assert list(reader.pushFilters(left + pushed)) == left
    assert [task.spans for task in reader.partitions()] == [[(1, 3, 4)]]
    nothing = NotedSource({"path": str(tmp_path)}).reader(None)
    list(nothing.pushFilters([EqualTo(("source_folder_id",), 7)]))
    assert [task.spans for task in nothing.partitions()] == [[]]


def test_only_the_asked_spans_are_fetched(spark, tmp_path, rows):
    spark.dataSource.register(NotedSource)
    found = read_connector(spark, "noted_mail", path=str(tmp_path))
    asked = found.filter("source_folder_id = 2 and uid >= 5").select("uid", "rfc822_data", "size_bytes")
    # a message that could not be fetched stays, without bytes
    assert rows(asked) == [(5, b"xxxxx", 5), (6, None, None)]
    assert os.listdir(tmp_path) == ["2-5-6"]


def test_captures_keep_every_message(spark, tmp_path, rows):
    spark.dataSource.register(cn.CapturedSource)
    path = f"file:{tmp_path}/mail"
    pairs = [(f, u) for f in range(3) for u in range(1, 40)]
    cn.capture(mail(spark, pairs[:60]), path)
    cn.capture(mail(spark, pairs[60:]), path)
    found = read_connector(spark, "captured_mail", path=path, uids_per_partition="7")
    assert found.rdd.getNumPartitions() == 17
    assert rows(found, "source_folder_id", "uid") == sorted(pairs, key=repr)
    assert found.filter(F.col("rfc822_data") != F.encode(F.concat_ws("/", "source_folder_id", "uid"), "UTF-8")).count() == 0


def test_a_stream_goes_on_from_its_checkpoint(spark, tmp_path):
    spark.dataSource.register(cn.CapturedSource)
    path, out = f"{tmp_path}/mail", f"{tmp_path}/out"
    seen = []
    for last in (3, 5):
        cn.capture(mail(spark, [(1, u) for u in range(last - 1, last + 1)] + [(last, 1)]), path)
        (
            stream_connector(spark, "captured_mail", path=path).writeStream.format("parquet")
            .option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True)
            .start(out).awaitTermination()
        )
        seen.append(sorted(tuple(r) for r in spark.read.parquet(out).select("source_folder_id", "uid").collect()))
    assert seen == [[(1, 2), (1, 3), (3, 1)], [(1, 2), (1, 3), (1, 4), (1, 5), (3, 1), (5, 1)]]


def test_a_stream_of_too_many_folders_is_an_error(tmp_path, monkeypatch):
    monkeypatch.setattr(cn, "STREAM_FOLDERS", 1)
    with pytest.raises(ValueError, match="2 folders"):
        NotedSource({"path": str(tmp_path)}).streamReader(None).latestOffset()


def test_tasks_hold_messages_however_far_apart_their_uids_lie():
    # 30 folders of 4 messages each over a million uids
    spans = [(folder, folder, 1_000_000 + folder, 4) for folder in range(30)]
    assert [len(task.spans) for task in cn.cut(spans, 40)] == [10, 10, 10]
    # one that does not fit is cut by its width
    assert [t.spans for t in cn.cut([(1, 1, 1000, 10)], 5)] == [[(1, 1, 500)], [(1, 501, 1000)]]
    assert cn.disjoint([(1, 5, 9, 2), (1, 1, 5, 3), (2, 1, 1, 1)]) == [(1, 1, 9, 5), (2, 1, 1, 1)]


def test_sparse_captures_are_few_tasks_and_each_opens_its_files_once(spark, tmp_path, rows, monkeypatch):
    monkeypatch.setattr(cn, "CAPTURED_ROWS", 5)
    spark.dataSource.register(cn.CapturedSource)
    path = f"{tmp_path}/mail"
    pairs = [(n % 40, 1 + n * 5000) for n in range(200)]
    # two arrivals whose spans overlap, and a row that comes with both
    cn.capture(mail(spark, pairs[::2] + pairs[1:2]), path)
    cn.capture(mail(spark, pairs[1::2]), path)
    found = read_connector(spark, "captured_mail", path=path, uids_per_partition="50")
    assert found.rdd.getNumPartitions() <= 6
    assert rows(found, "source_folder_id", "uid") == sorted([*pairs, pairs[1]], key=repr)
    some = found.filter("source_folder_id in (3, 39) and uid > 100000")
    assert rows(some, "source_folder_id", "uid") == sorted(
        [(f, u) for f, u in [*pairs, pairs[1]] if f in (3, 39) and u > 100000], key=repr)

    client, opened = cn.CapturedMail(path), []
    held = client._open
    monkeypatch.setattr(client, "_open", lambda: opened.append(1) or held())
    spans = cn.disjoint(client.list_spans())
    opened.clear()
    assert len(list(client.fetch_spans([s[:3] for s in spans]))) == 201
    # the index and the mail, not once a folder
    assert len(opened) == 2


def test_a_stream_takes_sparse_folders_by_their_messages(spark, tmp_path):
    spark.dataSource.register(cn.CapturedSource)
    path = f"{tmp_path}/mail"
    cn.capture(mail(spark, [(f, 1 + f + 90_000 * n) for f in range(20) for n in range(3)]), path)
    stream = cn.CapturedSource({"path": path, "uids_per_partition": "30"}).streamReader(None)
    end = stream.latestOffset()
    assert len(stream.partitions({}, end)) == 2
    start = {folder: last - 1 for folder, last in end.items()}
    left = [span for task in stream.partitions(start, end) for span in task.spans]
    assert left == [(f, 180_001 + f, 180_001 + f) for f in range(20)]
