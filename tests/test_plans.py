"""Plan shapes that must hold whatever the size of the data."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from ledgerflow.operators import attachments as att
from ledgerflow.operators import commit as cm
from ledgerflow.operators import selection as sel
from ledgerflow.operators.joins import lookup_join, salted_join
from ledgerflow.plans import registry
from ledgerflow.plans.fixtures import Inputs
from ledgerflow.session import configure
from ledgerflow.sources import objects as ob

# queries that write on the way to their result
EAGER = {
    "commit_visible", "metrics_round_trip", "incremental_stream", "folder_state",
    "stored_attachments", "idempotent_replay", "run_summary", "clear_invoices", "clear_folders",
    "delete_by_prefix", "delete_sources", "stream_after_batch", "stream_two_checkpoints",
    "run_missing_context", "isolated_failures", "capped_runs", "run_documents",
    "pruned_fetch", "laid_out_run", "scan_messages", "stream_connector", "keyed_marks",
}


def plan(frame) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        frame.explain("formatted")
    return out.getvalue()


@contextlib.contextmanager
def no_broadcast(spark):
    """Plans as they are when no side is small."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", [n for n in registry.QUERIES if n not in EAGER])
def test_no_pairwise_joins(spark, sf_dir, name):
    text = plan(registry.QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_selection_limits_before_the_shuffle(spark, sf_dir):
    inputs = Inputs(spark, sf_dir)
    with no_broadcast(spark):
        text = plan(sel.select_batch(inputs.messages(), inputs.state(), 2000, 100))
    # before and after the shuffle, for the parts and for the whole folder
    assert text.count("WindowGroupLimit (") >= 4


def test_selection_never_reads_the_raw_bytes(spark, tmp_path):
    rows = [(1, 1, bytearray(b"x"), 1)]
    path = str(tmp_path / "m")
    spark.createDataFrame(
        rows, "source_folder_id long, uid long, rfc822_data binary, size_bytes long"
    ).write.parquet(path)
    from ledgerflow.sources.messages import message_keys, read_messages

    state = spark.createDataFrame(
        [(1, None, None)], "source_folder_id long, high_water_mark long, low_water_mark long"
    )
    text = plan(sel.select_batch(message_keys(read_messages(spark, path)), state))
    assert "rfc822_data" not in text


def test_insert_shuffles_the_batch_once_for_both_conflict_steps(spark, sf_dir):
    inputs = Inputs(spark, sf_dir)
    with no_broadcast(spark):
        text = plan(cm.new_rows(inputs.invoices(), inputs.existing_invoices(), ["uid"]))
    # one for the batch, one for the numbers that are taken
    assert text.count("hashpartitioning(invoice_number") == 2
    assert "WindowGroupLimit" in text


def test_upload_shuffles_the_bytes_once(spark, sf_dir):
    inputs = Inputs(spark, sf_dir)
    with no_broadcast(spark):
        text = plan(att.upload_missing(att.with_file_key(inputs.files()), inputs.stored_files()))
    assert text.count("hashpartitioning(file_key") == 2


def test_lookup_join_can_split_a_hot_key(spark):
    facts = spark.range(0, 9000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"), F.col("id").alias("uid")
    )
    lookup = spark.range(0, 9000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    with no_broadcast(spark):
        joined = lookup_join(facts, lookup, ["k"])
        # both sides are shuffled for this join alone, and nothing is copied
        assert plan(joined).count("hashpartitioning(k") == 2 and "Generate" not in plan(joined)
        assert joined.count() == 9000 and joined.filter("v != k * 2").isEmpty()
        semi = lookup_join(facts, lookup.filter("k < 10"), ["k"], how="left_semi")
        anti = lookup_join(facts, lookup.filter("k < 10"), ["k"], how="left_anti")
        assert semi.count() + anti.count() == 9000
        left = lookup_join(facts, lookup.filter("k < 10"), ["k"], how="left")
        assert left.count() == 9000


def test_filters_and_columns_reach_the_scan(spark, sf_dir, tmp_path):
    inputs = Inputs(spark, sf_dir)
    path = str(tmp_path / "objects")
    inputs.stored_files().write.parquet(path)
    text = plan(ob.list_objects(spark.read.parquet(path), "1"))
    assert "StringStartsWith(file_key,1)" in text and "data:binary" not in text
    folders = str(tmp_path / "folders")
    inputs.folders().write.parquet(folders)
    from ledgerflow.sources.tables import folder_by_id

    assert "EqualTo(id,23)" in plan(folder_by_id(spark.read.parquet(folders), 23))


def test_copies_of_a_lookup_side_are_not_broadcast(spark, tmp_path):
    spark.range(1000).selectExpr("id AS k", "id * 2 AS v").write.parquet(str(tmp_path / "lookup"))
    facts = spark.range(9000).selectExpr("id % 1200 AS k", "id AS uid")
    joined = salted_join(facts, spark.read.parquet(str(tmp_path / "lookup")), ["k"], ["uid"])
    assert "BroadcastExchange" not in plan(joined)
    assert joined.count() == 7600 and joined.filter("v != k * 2").isEmpty()


def test_a_table_that_grows_when_it_is_read_is_not_broadcast_for_its_files(spark, tmp_path):
    rows = spark.range(400_000).selectExpr("id AS k", "'INBOX' AS name", "'no response' AS error")
    rows.coalesce(1).write.parquet(str(tmp_path / "lookup"))
    # the files are far below the threshold, the rows are not
    assert sum(f.stat().st_size for f in (tmp_path / "lookup").iterdir()) < 4_000_000
    assert "BroadcastExchange" in plan(spark.range(10).join(spark.range(9).selectExpr("id"), "id"))
    lookup = configure(spark).read.parquet(str(tmp_path / "lookup"))
    joined = spark.range(100_000, 3_000_000).selectExpr("id AS k").join(lookup, "k")
    assert "BroadcastExchange" not in plan(joined)
    assert joined.count() == 300_000
