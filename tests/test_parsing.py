"""The parse job on messages of every shape, and attachment keys."""

from pathlib import PurePosixPath

import pytest
from pyspark.sql import functions as F

from ledgerflow.functions.keys import base_name
from ledgerflow.operators import attachments as att
from ledgerflow.operators import parsing
from ledgerflow.sources.messages import message_keys, read_connector, read_eml

HTML = "Content-Type: text/html; charset=utf-8\r\n\r\n <p>h</p> "


def multipart(*parts, kind="mixed"):
    joined = "".join(f"--b\r\n{p}\r\n" for p in parts)
    return f"Subject: s\r\nContent-Type: multipart/{kind}; boundary=b\r\n\r\n{joined}--b--\r\n"


MAILS = {
    "plain": "Subject: s\r\nFrom: f\r\nTo: t\r\nDate: d\r\nMessage-ID: <m>\r\n\r\n  body \r\n",
    "bare": "\r\nbody",
    "html": "Subject: s\r\n" + HTML,
    "other": "Content-Type: application/json\r\n\r\n{}",
    "alternative": multipart("Content-Type: text/plain\r\n\r\none", HTML,
                             "Content-Type: text/plain\r\n\r\ntwo", kind="alternative"),
    "charset": "Content-Type: text/plain; charset=no-such\r\n\r\nas sent ",
    "part_charset": multipart("Content-Type: text/plain; charset=no-such\r\n\r\nlost",
                              "Content-Type: text/plain\r\n\r\nkept"),
    "inline_file": multipart('Content-Type: text/plain; name="a.txt"\r\n\r\ninline text'),
    "attached": multipart('Content-Type: text/plain\r\nContent-Disposition: attachment; filename="a.txt"\r\n\r\nfile',
                          "Content-Type: text/plain\r\n\r\nbody"),
    "upper": multipart('Content-Type: text/plain\r\nContent-Disposition: ATTACHMENT; filename="a.txt"\r\n\r\nfile'),
    "message": multipart('Content-Type: message/rfc822\r\nContent-Disposition: attachment; filename="m.eml"\r\n\r\n'
                         "Subject: inner\r\n\r\ninner body"),
    "encoded": "Subject: =?utf-8?q?caf=C3=A9?=\r\n\r\nx",
    "empty_part": multipart("Content-Type: text/plain\r\n\r\n", "Content-Type: text/plain\r\n\r\nsecond"),
    "surrogate": "Content-Type: text/plain; charset=unicode_escape\r\n\r\n\\ud800",
}
RAW = {name: text.encode() for name, text in MAILS.items()}
RAW["empty"] = b""
RAW["latin"] = "Subject: s\r\nContent-Type: text/plain; charset=latin-1\r\n\r\nÄ".encode("latin-1")
RAW["broken_utf8"] = b"Content-Type: text/plain; charset=utf-8\r\n\r\na\xffb"
RAW["raw_subject"] = "Subject: café\r\n\r\nx".encode()


@pytest.fixture(scope="module")
def parsed(spark):
    names = list(RAW)
    frame = spark.createDataFrame(
        [(1, k, names[k], bytearray(RAW[names[k]])) for k in range(len(names))],
        "source_folder_id long, uid long, name string, rfc822_data binary",
    )
    return {r.name: r for r in parsing.parse_messages(frame).collect()}


@pytest.mark.parametrize("name, text, html", [
    ("plain", "body", None), ("bare", "body", None), ("html", None, "<p>h</p>"), ("other", "{}", None),
    ("alternative", "one", "<p>h</p>"), ("charset", "as sent", None), ("part_charset", "kept", None),
    ("inline_file", "inline text", None), ("attached", "body", None), ("upper", "file", None),
    ("empty_part", "", None), ("empty", None, None), ("latin", "Ä", None), ("broken_utf8", "ab", None),
])
def test_bodies(parsed, name, text, html):
    assert (parsed[name].body_text, parsed[name].body_html) == (text, html)


def test_headers(parsed):
    r = parsed["plain"]
    assert (r.subject, r.from_address, r.to_address, r.date, r.message_id) == ("s", "f", "t", "d", "<m>")
    r = parsed["bare"]
    assert (r.subject, r.from_address, r.to_address, r.date, r.message_id) == ("", "", "", "", None)
    assert parsed["encoded"].subject == "=?utf-8?q?caf=C3=A9?="
    assert parsed["raw_subject"].subject == "café"


def test_attachments(parsed):
    def files(name):
        return [(a.filename, a.content_type, bytes(a.data), a.size_bytes) for a in parsed[name].attachments]

    assert files("inline_file") == [("a.txt", "text/plain", b"inline text", 11)]
    assert files("attached") == [("a.txt", "text/plain", b"file", 4)]
    # an attached message has no payload of its own
    assert files("message") == []
    assert files("plain") == []


def test_a_bad_message_is_set_aside_alone(parsed):
    assert [n for n, r in parsed.items() if r.parse_error is not None] == ["surrogate"]


def test_large_messages_are_flushed_in_parts(spark, monkeypatch):
    monkeypatch.setattr(parsing, "FLUSH_BYTES", 100)
    raw = spark.range(0, 50).select(
        F.lit(1).cast("long").alias("source_folder_id"), F.col("id").alias("uid"),
        F.concat(F.lit("Subject: n"), F.col("id").cast("string"), F.lit("\r\n\r\n"), F.repeat(F.lit("x"), 60))
        .cast("binary").alias("rfc822_data"),
    )
    got = {r.uid: r.subject for r in parsing.parse_messages(raw).collect()}
    assert got == {k: f"n{k}" for k in range(50)}


def test_base_name_equals_path_name(spark):
    names = ["a/b.pdf", "..", ".", "/", "", "a\\b", "a/", "a//", "a/.", "./a", "/x/y/", "a/..", "a/./.", "//a"]
    frame = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in frame.select(base_name(F.col("n"))).collect()]
    assert got == [PurePosixPath(n).name for n in names]


def test_upload_takes_the_first_of_equal_keys_once(spark, rows):
    files = spark.createDataFrame(
        [(1, 1, 0, "k", "t", bytearray(b"a")), (1, 1, 1, "k", "t", bytearray(b"bb")),
         (1, 2, 0, "old", "t", bytearray(b"c"))],
        "source_folder_id long, uid long, position int, file_key string, content_type string, data binary",
    )
    stored = spark.createDataFrame([("old",)], "file_key string")
    new = att.upload_missing(files, stored)
    assert [(r.file_key, bytes(r.data), r.size_bytes) for r in new.collect()] == [("k", b"a", 1)]
    assert rows(att.key_collisions(files)) == [("k", 2)]


def test_connectors(spark, tmp_path):
    for folder, uid in [(3, 7), (3, 8), (4, 1)]:
        (tmp_path / "mail" / str(folder)).mkdir(parents=True, exist_ok=True)
        (tmp_path / "mail" / str(folder) / f"{uid}.eml").write_bytes(RAW["plain"])
    (tmp_path / "mail" / "notes.eml").write_bytes(b"not in a folder")
    mail = read_eml(spark, str(tmp_path / "mail"))
    assert sorted((r.source_folder_id, r.uid) for r in mail.collect()) == [(3, 7), (3, 8), (4, 1)]
    assert parsing.parse_messages(mail).filter("subject = 's'").count() == 3

    from pyspark.sql.datasource import DataSource, DataSourceReader

    class Mailbox(DataSource):
        @classmethod
        def name(cls):
            return "mailbox"

        def schema(self):
            return "source_folder_id int, uid int, rfc822_data binary, flags string"

        def reader(self, schema):
            class Reader(DataSourceReader):
                def read(self, partition):
                    yield (1, 2, b"Subject: x\r\n\r\ny", "seen")
                    yield (1, 3, None, "gone")

            return Reader()

    spark.dataSource.register(Mailbox)
    mail = read_connector(spark, "mailbox")
    assert mail.columns == ["source_folder_id", "uid", "rfc822_data"]
    assert sorted((r.uid, r.readable) for r in message_keys(mail).collect()) == [(2, True), (3, False)]
    assert parsing.parse_messages(mail).first().subject == "x"


def test_little_is_held_parsed_at_once():
    # parsed texts take several times their bytes, in every Python worker of an executor
    assert parsing.FLUSH_BYTES <= 4 << 20


def test_few_bytes_of_mail_are_many_tasks(spark):
    # a small table: one split, and one task behind a shuffle that Spark cuts by bytes
    mail = spark.range(0, 500, 1, 1).select(
        F.lit(1).cast("long").alias("source_folder_id"), F.col("id").alias("uid"),
        F.lit("Subject: x\r\n\r\ny").cast("binary").alias("rfc822_data"))
    joined = mail.join(spark.range(0, 500).withColumnRenamed("id", "uid"), "uid")
    placed = parsing.parse_texts(parsing.dealt(joined)).withColumn("task", F.spark_partition_id())
    sizes = [r["count"] for r in placed.groupBy("task").count().collect()]
    assert len(sizes) >= 3 * spark.sparkContext.defaultParallelism
    assert sum(sizes) == 500 and max(sizes) < 100


def test_few_messages_are_dealt_over_few_tasks(spark):
    cores = spark.sparkContext.defaultParallelism
    messages = spark.range(10).select("id", F.lit(b"Subject: a\r\n\r\n").alias("rfc822_data"))
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 3 * cores + 40)
    try:
        def tasks(expected):
            return parsing.dealt(messages, expected).rdd.getNumPartitions()

        assert tasks(10) == 3 * cores
        assert tasks((3 * cores + 1) * parsing.MESSAGES_PER_TASK) == 3 * cores + 1
        assert tasks(10**9) == tasks(None) == 3 * cores + 40
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
