"""Selection against brute force, on folders of every kind."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerflow.operators import commit as cm
from ledgerflow.operators import selection as sel

STATE = "source_folder_id long, high_water_mark long, low_water_mark long"


def brute_force(messages, state, batch, chunk):
    chosen = set()
    for folder, high, low in state:
        uids = [u for f, u in messages if f == folder]
        first = high is None and low is None
        if first:
            taken = sorted(sorted(uids)[-batch:])
        else:
            new = [u for u in uids if high is not None and u > high]
            old = []
            if low is not None and low > 1:
                old = [u for u in uids if max(1, low - batch) <= u <= low - 1]
            taken = sorted(new + old, reverse=True)[:batch]
        for place, uid in enumerate(taken):
            chosen.add((folder, uid, first, place // chunk + 1))
    return chosen


def frames(spark, messages, state):
    return (
        spark.createDataFrame(messages, "source_folder_id long, uid long"),
        spark.createDataFrame(state, STATE),
    )


def made_up(seed):
    rng = random.Random(seed)
    messages, state = [], []
    for folder in range(12):
        span = rng.choice([5, 40, 400])
        count = rng.randint(0, min(span, 60))
        messages += [(folder, u) for u in rng.sample(range(1, span + 1), count)]
        marks = rng.choice(["first", "both", "high", "low", "edge", "idle"])
        high, low = sorted(rng.sample(range(1, span + 1), 2), reverse=True)
        state.append({
            "first": (folder, None, None), "both": (folder, high, low),
            "high": (folder, high, None), "low": (folder, None, low),
            "edge": (folder, high, 1), "idle": (folder, span, low),
        }[marks])
    # one folder holds more than a third of all rows
    messages += [(99, u) for u in range(1, 400)]
    state.append(rng.choice([(99, None, None), (99, 350, 200), (99, 100, 50)]))
    # a folder without state is not processed
    messages += [(77, 1), (77, 2)]
    return messages, state


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("batch, chunk", [(10, 3), (20, 20), (1000, 100)])
def test_select_batch_equals_brute_force(spark, seed, batch, chunk):
    messages, state = made_up(seed)
    got = sel.select_batch(*frames(spark, messages, state), batch, chunk)
    assert {tuple(r) for r in got.collect()} == brute_force(messages, state, batch, chunk)


@pytest.mark.parametrize("span", [4, 64, 4096])
def test_uncapped_chunks_equal_capped_ones(spark, rows, span):
    messages, state = made_up(1)
    eligible = sel.select_join(*frames(spark, messages, state), 10_000)
    assert rows(sel.number_chunks_uncapped(eligible, 7, span), "source_folder_id", "uid", "chunk_num") == rows(
        sel.number_chunks(eligible, 7), "source_folder_id", "uid", "chunk_num"
    )


def test_idle_folder_reads_nothing(spark):
    messages, state = frames(spark, [(1, 5), (1, 9)], [(1, 9, 1)])
    assert sel.select_batch(messages, state).isEmpty()


def test_chunk_sizes(spark):
    messages, state = frames(spark, [(1, u) for u in range(1, 8)], [(1, None, None)])
    for chunk, sizes in [(7, [7]), (3, [3, 3, 1]), (1, [1] * 7)]:
        counted = sel.select_batch(messages, state, 10, chunk).groupBy("chunk_num").count()
        assert [r["count"] for r in counted.orderBy("chunk_num").collect()] == sizes


def test_order_of_first_and_later_runs(spark):
    messages, state = frames(
        spark, [(f, u) for f in (1, 2) for u in (10, 20, 30)], [(1, None, None), (2, 5, 1)]
    )
    got = {(r[0], r[1]): r[3] for r in sel.select_batch(messages, state, 10, 1).collect()}
    assert [got[1, u] for u in (10, 20, 30)] == [1, 2, 3]
    assert [got[2, u] for u in (10, 20, 30)] == [3, 2, 1]


def test_unreadable_messages_take_a_place_but_no_chunk(spark):
    messages = spark.createDataFrame(
        [(1, u, u != 4) for u in range(1, 6)], "source_folder_id long, uid long, readable boolean"
    )
    state = spark.createDataFrame([(1, None, None)], STATE)
    got = sel.select_batch(messages, state, 3, 2).collect()
    assert {(r.uid, r.chunk_num) for r in got} == {(3, 1), (5, 1)}


def test_empty_span_stalls_unless_advanced(spark, rows):
    messages, state = frames(spark, [(1, 3), (1, 100), (2, 95), (2, 100)], [(1, 100, 100), (2, 100, 100)])
    assert rows(sel.select_batch(messages, state, 10, 5), "source_folder_id", "uid") == [(2, 95)]
    assert rows(cm.advance_empty_spans(state, messages, 10)) == [(1, 100, 90)]


def test_backfill_reaches_the_first_message(spark):
    """Run after run a folder is read down to uid 1, and no message twice."""
    messages = spark.createDataFrame([(1, u) for u in range(1, 36)], "source_folder_id long, uid long")
    state = spark.createDataFrame([(1, None, None)], STATE)
    seen = []
    for _ in range(5):
        chosen = sel.select_batch(messages, state, 10, 5)
        seen += [r.uid for r in chosen.collect()]
        merged = cm.merge_watermarks(state, cm.uid_bounds(chosen))
        state = spark.createDataFrame(cm.next_state(state, merged).collect(), STATE)
    assert sorted(seen) == list(range(1, 36))
    assert state.first()[1:] == (35, 1)


def test_ranking_sees_a_bounded_part_of_a_hot_folder(spark):
    """The second rank gets at most parts x n rows of a folder, however many there are."""
    hot = spark.range(0, 20_000).select(F.lit(1).cast("long").alias("source_folder_id"), F.col("id").alias("uid"))
    got = sel.newest_per_folder(hot, 5, parts=8)
    assert sorted(r.uid for r in got.collect()) == list(range(19_995, 20_000))
