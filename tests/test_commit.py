"""Conflicts, marks, ids, the ledger's visibility rules and deletes."""

import pytest
from pyspark.sql import functions as F

from ledgerflow import new_run_dir, schemas, shared_dir
from ledgerflow.operators import commit as cm
from ledgerflow.operators import quality as ql
from ledgerflow.operators import reconcile as rc
from ledgerflow.operators.ledger import Ledger
from ledgerflow.plans.fixtures import Inputs, now
from ledgerflow.plans.run import run_context

BATCH = "pos long, invoice_number string, user_id string"


@pytest.fixture
def batch(spark):
    return spark.createDataFrame(
        [(1, "A", "u"), (2, "A", "v"), (3, None, "u"), (4, None, "u"), (5, "B", "u"), (6, "C", "u")],
        BATCH,
    )


def test_first_of_a_number_wins_and_nulls_stay(batch, rows):
    assert rows(cm.first_wins(batch, ["pos"]), "pos") == [(1,), (3,), (4,), (5,), (6,)]


def test_taken_numbers_are_skipped(spark, batch, rows):
    existing = spark.createDataFrame([(7, "B"), (9, None)], "id long, invoice_number string")
    got = cm.insert_invoices(batch, existing, ["pos"])
    assert rows(got, "pos") == [(1,), (3,), (4,), (6,)]
    ids = [r.id for r in got.collect()]
    assert len(set(ids)) == 4 and min(ids) > 9


def test_narrower_conflict_keys(spark, batch, rows):
    existing = spark.createDataFrame(
        [(1, "A", "v")], "id long, invoice_number string, user_id string"
    )
    got = cm.insert_invoices(batch, existing, ["pos"], ["invoice_number", "user_id"])
    assert rows(got, "pos") == [(1,), (3,), (4,), (5,), (6,)]


def test_a_hot_number_and_hot_nulls(spark):
    """A third of the rows share a number and a third have none; nothing gets lost."""
    hot = spark.range(0, 3000).select(
        F.col("id").alias("pos"),
        F.when(F.col("id") % 3 == 0, "HOT").when(F.col("id") % 3 == 1, F.concat(F.lit("N"), "id"))
        .alias("invoice_number"),
    )
    existing = spark.createDataFrame([], "id long, invoice_number string")
    got = cm.insert_invoices(hot, existing, ["pos"])
    assert got.count() == 1 + 1000 + 1000
    assert got.filter("invoice_number = 'HOT'").first().pos == 0
    assert got.select("id").distinct().count() == 2001


def test_ids_are_unique_and_the_same_every_time(spark, rows):
    frame = spark.range(0, 20_000).withColumnRenamed("id", "k")
    first = rc.assign_ids(frame, ["k"], F.lit(100))
    again = rc.assign_ids(frame.repartition(3), ["k"], F.lit(100))
    assert rows(first) == rows(again)
    assert first.select("id").distinct().count() == 20_000
    assert first.agg(F.min("id")).first()[0] > 100


def test_merge_moves_outward_only(spark, rows):
    state = spark.createDataFrame(
        [(1, None, None), (2, 10, 5), (3, 10, 5), (4, 10, None), (5, 10, 5)],
        "source_folder_id long, high_water_mark long, low_water_mark long",
    )
    bounds = spark.createDataFrame(
        [(1, 1, 8, 6), (1, 2, 5, 2), (2, 1, 8, 7), (3, 1, 12, 11), (4, 1, 9, 3)],
        "source_folder_id long, chunk_num int, max_uid long, min_uid long",
    )
    assert rows(cm.merge_watermarks(state, bounds)) == [
        (1, 8, 2), (2, 10, 5), (3, 12, 5), (4, 10, 3),
    ]


def test_reconcile_with_epoch_change_and_double_listing(spark, rows):
    folders = spark.createDataFrame(
        [(1, 1, "INBOX", "5"), (2, 1, "INBOX", "5"), (3, 1, "Old", "5")],
        "id long, source_id long, folder_name string, uid_validity string",
    )
    listing = spark.createDataFrame(
        [(1, "INBOX", "5"), (1, "INBOX", "5"), (1, "Old", "6"), (2, "INBOX", "5")],
        "source_id long, name string, uid_validity string",
    )
    assert rows(rc.reconcile_existing(listing, folders), "id", "folder_name") == [(1, "INBOX")]
    missing = rc.reconcile_missing(listing, folders)
    assert rows(missing) == [(1, "Old", "6"), (2, "INBOX", "5")]
    new = rc.create_folders(missing, folders, F.lit("2024-07-01").cast("timestamp"))
    assert new.filter("id > 3 and high_water_mark is null").count() == 2


# -- ledger --------------------------------------------------------------------


def invoice(spark, *numbers):
    return spark.createDataFrame([(n,) for n in numbers], "invoice_number string").select(*[
        F.col("invoice_number") if f.name == "invoice_number"
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schemas.INVOICE.fields
    ])


@pytest.fixture
def ledger(spark):
    return Ledger.create(spark, new_run_dir(spark, "test"))


def numbers(ledger):
    return sorted(r.invoice_number for r in ledger.read("invoice").collect())


def test_rows_show_only_after_the_commit(spark, ledger):
    ledger.stage("invoice", invoice(spark, "A"), 1)
    assert numbers(ledger) == []
    ledger.commit(1)
    assert numbers(ledger) == ["A"]


def test_a_second_attempt_replaces_the_first(spark, ledger):
    ledger.stage("invoice", invoice(spark, "A", "B"), 1)
    ledger.begin(1)
    # reads what is there while it writes
    ledger.stage("invoice", ledger.read("invoice").unionByName(invoice(spark, "B")), 1)
    ledger.commit(1)
    assert numbers(ledger) == ["B"]
    assert ledger.is_committed(1) and not ledger.is_committed(2)


def test_marks_only_move_outward_and_come_from_the_newest_batch(spark, ledger):
    def marks(*values):
        return spark.createDataFrame(
            [(1, *values)], "source_folder_id long, high_water_mark long, low_water_mark long"
        ).withColumn("processed_at", F.lit("2024-07-01").cast("timestamp"))

    ledger.stage("watermark", ledger.moved_marks(marks(20, 10)), 2)
    ledger.commit(2)
    ledger.stage("watermark", ledger.moved_marks(marks(15, 8)), 1)
    ledger.commit(1)
    ledger.stage("watermark", ledger.moved_marks(marks(99, 1)), 3)
    assert [tuple(r)[:3] for r in ledger.marks().collect()] == [(1, 20, 8)]


def test_intermediate_results_go_when_the_batch_is_done(spark, ledger):
    handed = ledger.hand_over("step", invoice(spark, "A"), 1)
    assert handed.count() == 1
    ledger.commit(1)
    ledger.release(1)
    path = f"{ledger.root}/work/step"
    assert spark.read.schema(schemas.INVOICE).parquet(path).isEmpty()


def test_scratch_space_is_what_the_cluster_names(spark):
    class Context:
        master = "spark://host:7077"

    class Session:
        sparkContext = Context()

        class conf:
            named = None

            @classmethod
            def get(cls, key, default=None):
                return cls.named

    with pytest.raises(RuntimeError):
        shared_dir(Session)
    Session.conf.named = "hdfs://shared/checkpoints/"
    assert shared_dir(Session) == "hdfs://shared/checkpoints"


def test_tokens_stay_out_of_derived_tables(spark, sf_dir):
    inputs = Inputs(spark, sf_dir)
    tokens = rc.source_tokens(inputs.sources(), inputs.refreshes(), now())
    names = rc.eligible_sources(inputs.sources(), tokens).columns
    names += run_context(inputs.listing(), inputs.folders(), inputs.sources()).columns
    assert not [n for n in names if "token" in n]


# -- deletes and gaps -------------------------------------------------------------


def test_deletes_follow_the_declared_effects(spark, rows):
    tables = {
        "user": spark.createDataFrame([("u",), ("v",)], "id string"),
        "source": spark.createDataFrame([(1, "u"), (2, "v")], "id long, user_id string"),
        "source_folder": spark.createDataFrame([(10, 1), (20, 2)], "id long, source_id long"),
        # an invoice of v that came through a source of u
        "invoice": spark.createDataFrame(
            [(100, "u", 1, 10), (200, "v", 2, 20), (300, "v", 1, 10), (400, "v", None, None)],
            "id long, user_id string, source_id long, source_folder_id long",
        ),
    }
    gone = spark.createDataFrame([("u",)], "id string")
    left = ql.delete_users(tables, gone)
    assert rows(left["user"]) == [("v",)]
    assert rows(left["source"], "id") == [(2,)]
    assert rows(left["source_folder"], "id") == [(20,)]
    assert rows(left["invoice"], "id", "user_id", "source_id", "source_folder_id") == [(200, "v", 2, 20), (300, "v", None, None), (400, "v", None, None)]


def test_gaps_lie_within_the_marks(spark, rows):
    messages = spark.createDataFrame([(1, u) for u in range(1, 9)], "source_folder_id long, uid long")
    state = spark.createDataFrame(
        [(1, 7, 2)], "source_folder_id long, high_water_mark long, low_water_mark long"
    )
    done = messages.filter(F.col("uid").isin(2, 3, 6, 7))
    assert rows(ql.unprocessed_gaps(messages, state, done)) == [(1, 4), (1, 5)]
