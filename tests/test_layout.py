"""Raw mail in places and buckets: what a fetch opens, shuffles and returns."""

import pytest
from pyspark.sql import functions as F

from ledgerflow.sources.layout import BAND, MailLayout
from test_plans import no_broadcast, plan

SCHEMA = "source_folder_id bigint, uid bigint, rfc822_data binary"


def mail(spark, pairs):
    return spark.createDataFrame([(f, u, f"{f}/{u}".encode()) for f, u in pairs], SCHEMA)


@pytest.fixture
def layout(spark, tmp_path):
    made = MailLayout.at(spark, str(tmp_path / "mail"), bands=8)
    made.append(mail(spark, [(f, u) for f in range(5) for u in range(1, 101)]), 0)
    made.append(mail(spark, [(f, u) for f in range(5) for u in range(101, 121)]), 1)
    return made


def chosen(spark, tmp_path, pairs, name="chosen"):
    path = str(tmp_path / name)
    mail(spark, pairs).drop("rfc822_data").withColumn("chunk_num", F.lit(1)).write.parquet(path)
    return spark.read.parquet(path)


def test_fetch_returns_the_selected_mail(spark, tmp_path, layout, rows):
    pairs = [(0, 1), (0, 120), (3, 100), (4, 101), (9, 1)]
    got = rows(layout.fetch(chosen(spark, tmp_path, pairs)), "source_folder_id", "uid", "rfc822_data", "chunk_num")
    assert got == [(f, u, f"{f}/{u}".encode(), 1) for f, u in pairs if f < 9]


def test_new_mail_opens_the_last_arrival_only(spark, tmp_path, layout):
    found = layout.fetch(chosen(spark, tmp_path, [(f, 120) for f in range(5)]))
    opened = [p for p in found.inputFiles() if "place=" in p]
    assert opened and all(int(p.split("place=")[1].split("/")[0]) >= 8 for p in opened)
    one = layout.fetch(chosen(spark, tmp_path, [(2, 5)], "one"))
    assert len({p.split("place=")[1].split("/")[0] for p in one.inputFiles() if "place=" in p}) == 1


def test_bytes_are_not_shuffled(spark, tmp_path, layout):
    with no_broadcast(spark):
        text = plan(layout.fetch(chosen(spark, tmp_path, [(f, 7) for f in range(5)])))
    exchanges = [part for part in text.split("\n\n") if ") Exchange" in part.split("\n")[0]]
    assert exchanges and not any("rfc822_data" in part for part in exchanges)
    assert "PartitionFilters: [isnotnull(place" in text or "place#" in text.split("PartitionFilters")[1]


def test_keys_read_no_bytes(layout):
    text = plan(layout.keys())
    assert "rfc822_data" not in text.split("ReadSchema")[1].split("\n")[0]


def test_an_arrival_written_again_replaces_itself(spark, layout):
    layout.append(mail(spark, [(f, u) for f in range(5) for u in range(101, 121)]), 1)
    assert layout.messages().count() == 600


def test_bands_split_a_hot_folder(spark, tmp_path):
    made = MailLayout.at(spark, str(tmp_path / "hot"), bands=8)
    made.append(mail(spark, [(1, u * BAND) for u in range(40)]), 0)
    assert made.messages().select("place").distinct().count() > 4


def test_a_layout_is_taken_up_again(spark, layout, rows):
    again = MailLayout.at(spark, layout.path, bands=8)
    assert rows(again.messages()) == rows(layout.messages())
    layout.append(mail(spark, [(7, 1)]), 2)
    again.refresh()
    assert again.messages().count() == 601


def test_an_empty_layout_and_an_empty_selection(spark, tmp_path, layout):
    nothing = chosen(spark, tmp_path, [(99, 1)])
    assert layout.fetch(nothing).count() == 0
    assert MailLayout.at(spark, str(tmp_path / "none")).fetch(nothing).count() == 0


def test_messages_that_could_not_be_fetched_stay_unreadable(spark, tmp_path, rows):
    made = MailLayout.at(spark, str(tmp_path / "lost"), bands=2)
    made.append(spark.createDataFrame([(1, 1, None), (1, 2, b"")], SCHEMA), 0)
    assert rows(made.keys()) == [(1, 1, False), (1, 2, True)]
