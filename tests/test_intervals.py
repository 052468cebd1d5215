"""Sets of uids as runs against Python sets, and what a batch opens of the ledger."""

import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerflow import new_run_dir
from ledgerflow.operators import intervals as iv
from ledgerflow.operators import selection as sel
from ledgerflow.operators.ledger import BUCKETS, Ledger

UIDS = "source_folder_id long, uid long"
RUNS = "source_folder_id long, span long, low long, high long"


def uids(rng, count=400):
    out = []
    for folder in (1, 2, 3):
        base = rng.choice([0, 4000, 4090, -5000])
        out += [(folder, base + rng.randint(0, 300)) for _ in range(count)]
    out += [(4, u) for u in range(4090, 8200)] + [(5, 7), (5, 7)]
    return out


def as_set(runs):
    out = set()
    for r in runs.collect():
        assert r.low // iv.SPAN == r.high // iv.SPAN == r.span
        mine = {(r.source_folder_id, u) for u in range(r.low, r.high + 1)}
        assert not out & mine
        out |= mine
    return out


def test_runs_hold_the_set_and_are_maximal(spark):
    rng = random.Random(2)
    rows = uids(rng)
    runs = iv.islands(spark.createDataFrame(rows, UIDS).repartition(4))
    assert as_set(runs) == set(rows)
    found = {(r.source_folder_id, r.low): r for r in runs.collect()}
    for r in found.values():
        # nothing touches a run but across the border of a span
        assert (r.high + 1) % iv.SPAN == 0 or (r.source_folder_id, r.high + 1) not in set(rows)
    assert iv.islands(spark.createDataFrame([], UIDS)).collect() == []


def test_merged_and_remaining_equal_set_operations(spark):
    rng = random.Random(3)
    one, two = uids(rng), uids(rng)
    first, second = (iv.islands(spark.createDataFrame(r, UIDS)) for r in (one, two))
    both = iv.merged(first.unionByName(second).unionByName(first))
    assert as_set(both) == set(one) | set(two)
    assert both.count() == iv.islands(spark.createDataFrame(one + two, UIDS)).count()
    asked = spark.createDataFrame([*two, *two, (9, 1)], UIDS)
    left = sorted(tuple(r) for r in iv.remaining(asked, first).collect())
    assert left == sorted(u for u in [*two, *two, (9, 1)] if u not in set(one))
    nested = spark.createDataFrame([(1, 0, 1, 100), (1, 0, 5, 6), (1, 0, 101, 102), (1, 0, 200, 200)], RUNS)
    assert sorted((r.low, r.high) for r in iv.merged(nested).collect()) == [(1, 102), (200, 200)]


def test_holes_lie_between_runs(spark):
    runs = iv.islands(spark.createDataFrame([(1, u) for u in (1, 2, 5, 4095, 4096)] + [(2, 9)], UIDS))
    assert sorted(tuple(r) for r in iv.holes(runs).collect()) == [(1, 3, 4), (1, 6, 4094)]


def test_gaps_are_what_no_run_holds_between_the_marks(spark):
    keys = spark.createDataFrame([(1, u, u != 6) for u in range(1, 21)], UIDS + ", readable boolean")
    marks = "source_folder_id long, high_water_mark long, low_water_mark long"
    state = spark.createDataFrame([(1, 18, 2)], marks)
    before = spark.createDataFrame([(1, 12, 9)], marks)
    done = iv.islands(spark.createDataFrame([(1, u) for u in (2, 3, 13, 17, 18)], UIDS))
    found = sel.gap_messages(keys, state, before, done)
    # 6 cannot be read, 9 to 12 were read before the ledger knew the folder
    assert sorted(r.uid for r in found.collect()) == [4, 5, 7, 8, 14, 15, 16]
    taken = sel.select_batch(keys, state, 5, 5, found)
    assert sorted(r.uid for r in taken.collect()) == [14, 15, 16, 19, 20]


# -- what a batch opens


@pytest.fixture
def ledger(spark):
    return Ledger.create(spark, new_run_dir(spark, "test"), buckets=8)


def invoices(spark, numbers):
    from ledgerflow import schemas

    kinds = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.INVOICE.fields}
    rows = spark.createDataFrame([(k, n) for k, n in enumerate(numbers)], "id long, invoice_number string")
    kinds |= {"id": F.col("id"), "invoice_number": F.col("invoice_number")}
    return rows.select(*kinds.values())


def test_conflicts_are_looked_for_in_the_buckets_of_the_batch(spark, ledger):
    ledger.stage("invoice", invoices(spark, [f"N{k}" for k in range(400)] + [None] * 200), 1)
    ledger.commit(1)
    batch = invoices(spark, ["N7", "N8", "new", None])
    buckets = ledger.touched("invoice", batch)
    assert 1 <= len(buckets) <= 3
    seen = ledger.read("invoice", buckets=buckets)
    # the buckets are a filter on the folders that are listed, and nothing but keys is read
    scan = seen.select("invoice_number")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[bucket#\d+ (IN|=)", scan), scan
    held = {r.invoice_number for r in seen.collect()}
    assert {"N7", "N8"} <= held and None not in held and len(held) < 400
    assert ledger.read("invoice").count() == 600 and ledger.newest().top_id == 599


def test_what_a_batch_reads_of_the_states_does_not_grow(spark, ledger):
    def step(batch_id, uid):
        rows = spark.createDataFrame([(f, uid) for f in range(20)], UIDS)
        ledger.begin(batch_id)
        marks = rows.select("source_folder_id", F.col("uid").alias("high_water_mark"),
                            F.col("uid").alias("low_water_mark"), F.lit(None).cast("timestamp").alias("processed_at"))
        ledger.stage("watermark", ledger.moved_marks(marks), batch_id)
        ledger.stage("processed", ledger.more_processed(rows), batch_id)
        ledger.commit(batch_id)
        return len(ledger.marks().inputFiles()), len(ledger.intervals().inputFiles())

    second, last = [step(b, b) for b in range(1, 13)][1::10]
    assert second == last and max(last) <= 8
    assert as_set(ledger.intervals()) == {(f, u) for f in range(20) for u in range(1, 13)}
    assert ledger.intervals().count() == 20
    # a batch of one message opens one bucket
    one = spark.createDataFrame([(3, 5)], UIDS)
    assert len(ledger.intervals(one).inputFiles()) == 1
    assert {tuple(r)[:3] for r in ledger.marks().collect()} == {(f, 12, 1) for f in range(20)}
    # a batch that touches few buckets leaves the others where they are
    ledger.begin("few")
    ledger.stage("processed", ledger.more_processed(one.withColumn("uid", F.col("uid") + 100)), "few")
    ledger.commit("few")
    moved = [p for p in ledger.newest().parts if p.batch_id == "few"]
    assert [p.table for p in moved] == ["processed"]


def test_buckets_stay_when_a_ledger_is_opened_again(spark, ledger):
    assert Ledger(spark, ledger.root).buckets == 8 != BUCKETS
