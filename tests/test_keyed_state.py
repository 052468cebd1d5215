"""Folder marks as keyed state: runs of uids, restarts, repeated and hot keys."""

import pytest
from hypothesis import given
from hypothesis import strategies as st

from ledgerflow.operators import intervals
from ledgerflow.streaming import keyed_state as ks

SCHEMA = "source_folder_id bigint, uid bigint"


@given(st.lists(st.lists(st.integers(0, 60))))
def test_runs_hold_the_uids_taken_in(batches):
    first, last, seen = [], [], set()
    for uids in batches:
        first, last, fresh = ks.merged_runs(first, last, uids)
        assert fresh == len(set(uids) - seen)
        seen |= set(uids)
    assert [u for a, b in zip(first, last) for u in range(a, b + 1)] == sorted(seen)
    # as few runs as it takes
    assert all(b + 1 < a for a, b in zip(first[1:], last))


@pytest.fixture
def drained(spark, tmp_path):
    def take(*pairs):
        spark.createDataFrame(pairs, SCHEMA).write.mode("append").parquet(str(tmp_path / "mail"))
        mail = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "mail"))
        ks.keep_runs(mail, str(tmp_path / "runs"), str(tmp_path / "checkpoint")).awaitTermination()
        return str(tmp_path / "runs")
    return take


def test_a_restart_goes_on_with_the_state(spark, drained, rows):
    old = spark.conf.get(ks.PROVIDER)
    drained((1, 1), (1, 2), (1, 9), (2, 5000), (None, 4), (3, None))
    path = drained((1, 2), (1, 3), (1, 9), (2, 1))
    assert rows(ks.marks(spark, path)) == [(1, 9, 1), (2, 5000, 1)]
    assert rows(ks.runs(spark, path)) == [(1, 0, 1, 3), (1, 0, 9, 9), (2, 0, 1, 1), (2, 1, 5000, 5000)]
    assert rows(intervals.holes(ks.runs(spark, path))) == [(1, 4, 8), (2, 2, 4999)]
    fresh = spark.read.schema(ks.OUTPUT).parquet(path).agg({"fresh": "sum"}).first()[0]
    assert fresh == 6
    assert spark.conf.get(ks.PROVIDER) == old


def test_far_apart_uids_share_keys_of_the_state_and_come_out_by_span(spark, drained, rows, tmp_path):
    pairs = [(folder, 100 + 4096 * span) for folder in (1, 2) for span in range(2 * ks.BLOCK)]
    drained(*pairs, (3, 4095), (3, 4096), (3, -1))
    path = drained(pairs[0], (1, 101), (3, 4097))
    held = spark.read.format("statestore").load(str(tmp_path / "checkpoint"), stateVarName="runs").count()
    # two folders of two blocks each; folder 3 lies in one block above 0 and in one below
    assert held == 6
    mine = [(f, u // 4096, u, u + ((f, u) == pairs[0])) for f, u in pairs]
    assert rows(ks.runs(spark, path)) == sorted(
        [*mine, (3, -1, -1, -1), (3, 0, 4095, 4095), (3, 1, 4096, 4097)], key=repr)
    written = spark.read.schema(ks.OUTPUT + ", epoch bigint").parquet(path)
    # an epoch writes the spans it has rows for
    assert rows(written.filter("epoch = 1").select("source_folder_id", "span", "fresh")) == [(1, 0, 1), (3, 1, 1)]


def test_a_folder_of_far_apart_uids_is_few_entries_of_the_state(spark, drained, rows, tmp_path):
    pairs = [(folder, 65_536 * place + folder) for folder in (1, 2) for place in range(200)]
    path = drained(*pairs)
    held = spark.read.format("statestore").load(str(tmp_path / "checkpoint"), stateVarName="runs").count()
    assert held == 2
    assert rows(ks.runs(spark, path)) == sorted([(f, u // 4096, u, u) for f, u in pairs], key=repr)


def test_a_block_of_many_runs_is_cut_into_parts(spark, drained, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(ks, "MOST_RUNS", 8)
    part = ks.SPAN * ks.PART
    # the run from 65,530 lies in two spans, and later in two parts
    first = [(1, uid) for uid in [*range(0, 20, 2), *range(part - 6, part + 6)]]
    drained(*first, (2, 7))

    def entries():
        return spark.read.format("statestore").load(str(tmp_path / "checkpoint"), stateVarName="runs").count()

    # one mark of the block, its two parts, and the block of the other folder
    assert entries() == 4
    path = drained((1, 1), (1, 2), (1, part), (1, part + 6), (1, 5 * part), (2, 8), (2, None))
    assert entries() == 5
    assert rows(ks.runs(spark, path)) == sorted([
        (1, 0, 0, 2), *[(1, 0, uid, uid) for uid in range(4, 20, 2)], (1, 15, part - 6, part - 1),
        (1, 16, part, part + 6), (1, 80, 5 * part, 5 * part), (2, 0, 7, 8)], key=repr)
    written = spark.read.schema(ks.OUTPUT + ", epoch bigint").parquet(path)
    assert rows(written.groupBy("source_folder_id", "epoch").sum("fresh")) == [
        (1, 0, 22), (1, 1, 3), (2, 0, 1), (2, 1, 1)]
    assert rows(written.filter("epoch = 1").select("source_folder_id", "span", "fresh")) == [
        (1, 0, 1), (1, 16, 1), (1, 80, 1), (2, 0, 1)]


@given(st.lists(st.lists(st.tuples(st.integers(-2, 2), st.integers(-40, 40)), min_size=1), min_size=1), st.integers(0, 9))
def test_rows_of_a_group_come_once_and_in_order(frames, most):
    import pandas as pd

    old, ks.ROWS_HELD = ks.ROWS_HELD, most
    try:
        found = ks.in_order(pd.DataFrame(f, columns=["source_folder_id", "uid"]) for f in frames)
    finally:
        ks.ROWS_HELD = old
    assert list(zip(*(column.tolist() for column in found))) == sorted({pair for f in frames for pair in f})
