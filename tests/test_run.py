"""Whole batches, the stream in several micro-batches, crashes and replays."""

import json
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from ledgerflow import new_run_dir
from ledgerflow.operators import metrics as mt
from ledgerflow.operators import scoring as sc
from ledgerflow.operators.ledger import Ledger
from ledgerflow.plans import run as rn
from ledgerflow.plans import run_queries
from ledgerflow.plans.fixtures import Inputs
from ledgerflow.sources.messages import stream_messages
from ledgerflow.streaming.incremental import ingest_arrivals, start_incremental

# the workers cannot import this file
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NOW = "2024-07-01"


def mail(uid, kind, number):
    return (
        f"Message-ID: <{uid}>\r\nSubject: {kind} {number}\r\nContent-Type: multipart/mixed; boundary=b\r\n\r\n"
        f"--b\r\nContent-Type: text/plain\r\n\r\n{kind}\r\n"
        f'--b\r\nContent-Type: text/plain\r\nContent-Disposition: attachment; filename="{uid}.txt"\r\n\r\nf\r\n--b--\r\n'
    ).encode()


def scorer(stage, sampling):
    """Reads kind and number back out of the prompt, as a model would."""

    def one(prompt):
        kind, number = next(
            line for line in prompt.splitlines() if line.startswith("Subject: ")
        ).removeprefix("Subject: ").split()
        if kind == "crash":
            return RuntimeError("model down")
        if stage == "classify":
            return json.dumps({"is_invoice": kind != "news"})
        if kind == "vague":
            return "cannot tell"
        amount = 1e12 if kind == "huge" else 5
        return json.dumps({"invoice_number": None if number == "-" else number, "total_amount": amount})

    return lambda asked: [one(p) for p in asked]


KINDS = ["bill", "news", "vague", "huge", "bill", "crash"]


@pytest.fixture(scope="module")
def messages(spark):
    rows = []
    for folder in (1, 2):
        for uid in range(1, 25):
            number = "-" if uid % 8 == 0 else f"N{uid % 9}"
            raw = mail(uid, KINDS[uid % 6], number)
            rows.append((folder, uid, bytearray(raw), len(raw)))
    return spark.createDataFrame(
        rows, "source_folder_id long, uid long, rfc822_data binary, size_bytes long"
    )


@pytest.fixture
def ledger(spark):
    folders = spark.createDataFrame(
        [(k, k, "INBOX", "1", None, None, None) for k in (1, 2)],
        "id long, source_id long, folder_name string, uid_validity string, "
        "high_water_mark long, low_water_mark long, last_processed_at timestamp",
    ).withColumns({c: F.lit(NOW).cast("timestamp") for c in ("created_at", "updated_at")})
    return Ledger.create(spark, new_run_dir(spark, "test"), folders)


@pytest.fixture(scope="module")
def context(spark):
    return spark.createDataFrame(
        [(k, k, "INBOX", "1", f"u{k}") for k in (1, 2)],
        "source_folder_id long, source_id long, folder_name string, uid_validity string, user_id string",
    )


ANSWER = rn.answers_from_scorer(scorer)


def stamp():
    return F.lit(NOW).cast("timestamp")


def found(ledger):
    return sorted((r.source_folder_id, r.uid) for r in ledger.read("invoice").collect())


def expected_invoices():
    taken, out = set(), []
    for folder in (1, 2):
        for uid in range(1, 25):
            if KINDS[uid % 6] != "bill":
                continue
            number = None if uid % 8 == 0 else f"N{uid % 9}"
            if number is None or number not in taken:
                out.append((folder, uid))
            taken.add(number)
    return out


def test_one_batch(spark, ledger, messages, context):
    sizes = rn.RunSizes(batch_size=100, chunk_size=10)
    rn.run_folders(ledger, 0, messages, ledger.state(), context, ANSWER, stamp(), sizes)
    assert found(ledger) == expected_invoices()
    assert sorted(tuple(r) for r in ledger.state().collect()) == [(1, 24, 1), (2, 24, 1)]
    status = {r.uid: r.status for r in ledger.read("outcome").filter("source_folder_id = 1").collect()}
    # a call that fails leaves the decision to the subject, and "crash" is no keyword
    names = {"bill": "invoice", "news": "non_invoice", "vague": "no_extraction",
             "huge": "failed", "crash": "non_invoice"}
    assert status == {uid: names[KINDS[uid % 6]] for uid in range(1, 25)}
    totals = mt.run_kpis(ledger.read("chunk_metrics")).first()
    assert (totals.emails_fetched, totals.invoices_found, totals.non_invoices) == (48, 16, 16)
    assert totals.emails_processed == 40 and totals.errors == 16 and totals.chunks == 6
    files = sorted(r.file_key for r in ledger.read("attachment").collect())
    bills = [uid for uid in range(1, 25) if KINDS[uid % 6] == "bill"]
    assert files == sorted(f"u{f}/{f}/INBOX/1/{u}/{u}.txt" for f in (1, 2) for u in bills)


def test_nothing_is_done_twice(spark, ledger, messages, context):
    for batch_id in (0, 0, 1):
        rn.run_folders(ledger, batch_id, messages, ledger.state(), context, ANSWER, stamp())
    assert found(ledger) == expected_invoices()
    assert ledger.read("outcome").count() == 48


def test_a_failed_chunk_leaves_no_rows_and_no_marks(spark, ledger, messages, context):
    failures = spark.createDataFrame([(1, 3)], "source_folder_id long, chunk_num int")
    sizes = rn.RunSizes(batch_size=100, chunk_size=10)
    rn.run_folders(ledger, 0, messages, ledger.state(), context, ANSWER, stamp(), sizes, failures)
    assert sorted(tuple(r) for r in ledger.state().collect()) == [(1, 20, 1), (2, 24, 1)]
    assert all(uid <= 20 for folder, uid in found(ledger) if folder == 1)
    rollup = mt.folder_rollup(
        rn.batch_rows(ledger, "chunk_metrics", 0), rn.failed_emails(ledger, 0, failures)
    )
    row = rollup.filter("source_folder_id = 1").first()
    assert row.emails_fetched == 24 and row.chunks_processed == 2
    # the next run picks the messages of that chunk up again
    rn.run_folders(ledger, 1, messages, ledger.state(), context, ANSWER, stamp(), sizes)
    assert found(ledger) == expected_invoices()


def test_a_crash_before_the_commit_changes_nothing(spark, ledger, messages, context, monkeypatch):
    def fail(self, batch_id):
        raise OSError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(Ledger, "commit", fail)
        with pytest.raises(OSError):
            rn.run_folders(ledger, 0, messages, ledger.state(), context, ANSWER, stamp())
    assert found(ledger) == [] and ledger.marks().isEmpty()
    rn.run_folders(ledger, 0, messages, ledger.state(), context, ANSWER, stamp())
    assert found(ledger) == expected_invoices()


def test_backfill_advances_over_empty_spans(spark, ledger, context):
    raw = mail(1, "bill", "X")
    rows = [(1, u, bytearray(raw), len(raw)) for u in (2, 50)]
    sparse = spark.createDataFrame(
        rows, "source_folder_id long, uid long, rfc822_data binary, size_bytes long"
    )
    sizes = rn.RunSizes(batch_size=1, chunk_size=1, advance_empty=True)
    wide = rn.RunSizes(batch_size=20, chunk_size=5, advance_empty=True)
    state = ledger.state().filter("source_folder_id = 1")
    rn.run_folders(ledger, 0, sparse, state, context, ANSWER, stamp(), sizes)
    lows = []
    for batch_id in (1, 2, 3):
        state = ledger.state().filter("source_folder_id = 1")
        rn.run_folders(ledger, batch_id, sparse, state, context, ANSWER, stamp(), wide)
        lows.append(ledger.state().filter("source_folder_id = 1").first().low_water_mark)
    assert lows == [30, 10, 2]


def test_stream_in_micro_batches_equals_one_batch(spark, ledger, messages, context):
    path = new_run_dir(spark, "arrivals")
    checkpoint = new_run_dir(spark, "checkpoint")

    def arrive(low, high):
        chosen = messages.filter(F.col("uid").between(low, high))
        chosen.coalesce(1).write.mode("append").parquet(path)

    def drain():
        stream = start_incremental(
            stream_messages(spark, path, files_per_batch=1), ledger, context, ANSWER, checkpoint,
            now=stamp,
        )
        stream.awaitTermination()

    arrive(1, 9)
    drain()
    arrive(10, 17)
    arrive(18, 24)
    drain()
    drain()
    assert ledger.committed().filter("batch_id <> 'genesis'").count() == 3
    assert sorted(tuple(r) for r in ledger.state().collect()) == [(1, 24, 1), (2, 24, 1)]
    assert ledger.read("outcome").count() == 48
    numbers = [r.invoice_number for r in ledger.read("invoice").collect()]
    numbered = [n for n in numbers if n]
    assert len(numbered) == len(set(numbered))
    wanted = expected_invoices()
    assert len(numbers) == len(wanted)


def test_a_micro_batch_that_comes_again_is_skipped(spark, ledger, messages, context):
    for _ in range(2):
        ingest_arrivals(ledger, 5, messages, context, ANSWER, stamp())
    assert ledger.read("outcome").count() == 48


def test_one_prompt_that_raises_costs_one_answer(spark):
    def picky(stage, sampling):
        def answer(asked):
            if any("bad" in p for p in asked):
                raise ValueError("no")
            return ["fine"] * len(asked)

        return answer

    rows = spark.range(1000).select("id", F.when(F.col("id") == 500, "bad").otherwise("good").alias("prompt"))
    out = sc.score_batch(rows.coalesce(2), "classify", picky).collect()
    assert [(r.id, r.error) for r in out if r.error] == [(500, "no")]
    assert sum(r.response == "fine" for r in out) == 999


def test_arrivals_out_of_order_and_other_writers(spark, ledger, messages, context):
    path, now_ = new_run_dir(spark, "arrivals"), stamp
    for low, high in ((10, 24), (1, 9)):
        chosen = messages.filter(F.col("uid").between(low, high))
        chosen.coalesce(1).write.mode("append").parquet(path)
    # a run with the number of the stream's first epoch comes first
    rn.run_folders(ledger, 0, messages.filter("uid in (4, 20)"), ledger.state(), context, ANSWER, stamp())
    for _ in range(2):
        start_incremental(
            stream_messages(spark, path, files_per_batch=1), ledger, context, ANSWER,
            new_run_dir(spark, "checkpoint"), now=now_,
        ).awaitTermination()
    times = ledger.processed().groupBy("source_folder_id", "uid").count()
    assert times.count() == 48 and times.filter("count > 1").isEmpty()
    assert sorted(tuple(r) for r in ledger.state().collect()) == [(1, 24, 1), (2, 24, 1)]


def test_mail_without_folder_or_source_is_reported(spark, ledger, messages, context):
    strays = messages.filter("uid <= 2").withColumn(
        "source_folder_id", F.when(F.col("source_folder_id") == 1, 3).otherwise(2).cast("long"))
    known = context.filter("source_folder_id = 1")
    ingest_arrivals(ledger, "strays", strays, known, ANSWER, stamp())
    rows = ledger.read("outcome").collect()
    assert sorted((r.source_folder_id, r.uid, r.status, r.error, r.committed) for r in rows) == [
        (2, u, "failed", "Source 2 not found", False) for u in (1, 2)
    ] + [(3, u, "failed", "Source folder 3 not found", False) for u in (1, 2)]
    assert ledger.marks().isEmpty() and found(ledger) == []
    results = rn.folder_results(ledger, "strays", known).collect()
    assert {(r.source_folder_id, r.error) for r in results} == {
        (1, None), (2, "Source 2 not found"), (3, "Source folder 3 not found")}
    # they are taken in once their folder is there
    ingest_arrivals(ledger, "again", strays.filter("source_folder_id = 2"), context, ANSWER, stamp())
    assert ledger.processed().count() == 2


def test_replaced_tables_and_flat_marks(spark, ledger, messages, context):
    for batch_id in range(2):
        part = messages.filter(F.col("uid") % 2 == batch_id)
        ingest_arrivals(ledger, batch_id, part, context, ANSWER, stamp())
    # however many batches there are, the marks are read from one part for each bucket
    parts = {f.rsplit("/", 1)[0] for f in ledger.marks().inputFiles()}
    assert len(parts) == len(ledger.touched("watermark", ledger.marks())) <= 2
    before = ledger.state().collect()
    ledger.replace("clear", {"invoice": ledger.read("invoice").limit(0)})
    assert found(ledger) == [] and ledger.read("outcome").count() == 48
    assert sorted(ledger.state().collect()) == sorted(before)
    ledger.replace("clear", {"outcome": ledger.read("outcome").limit(0)})  # done already: skipped
    assert ledger.read("outcome").count() == 48


def test_groups_fail_alone_and_later_runs_complete_them(spark, ledger, messages, context):
    def scorer_down(stage, sampling):
        inner = scorer(stage, sampling)

        def answer(asked):
            if any("bill N3" in p for p in asked):
                raise SystemExit("gone")
            return inner(asked)

        return answer

    sizes = rn.RunSizes(batch_size=100, chunk_size=10)
    only_two = F.when(F.col("source_folder_id") == 2, F.col("rfc822_data"))
    calm = messages.withColumn("rfc822_data", F.coalesce(only_two, F.lit(mail(1, "news", "-"))))
    folder = F.col("source_folder_id")

    def run(name, answer):
        return rn.run_isolated(
            ledger, name, calm, ledger.state(), context, answer, stamp(), sizes, groups=2, halvings=1, key=folder)

    failed = run("bad", rn.answers_from_scorer(scorer_down))
    assert [name for name, _ in failed] == ["bad-2-of-4"]
    assert {r.source_folder_id for r in ledger.processed().collect()} == {1}
    assert [r.source_folder_id for r in ledger.marks().collect()] == [1]
    told = ledger.read("outcome").filter("uid is null").collect()
    assert [(r.source_folder_id, r.status, r.committed) for r in told] == [(2, "failed", False)]
    assert run("bad", ANSWER) == []  # the same run, completed
    times = ledger.processed().groupBy("source_folder_id", "uid").count()
    assert times.count() == 48 and times.filter("count > 1").isEmpty()


def test_bytes_of_other_mail_are_never_written(spark, ledger, messages, context):
    rn.run_folders(ledger, 0, messages, ledger.state(), context, ANSWER, stamp(), rn.RunSizes(100, 10))
    binary = [
        f"{name}" for name in ("parsed", "classified", "extracted", "located", "file_keys", "selected")
        for f in spark.read.parquet(f"{ledger.root}/work/{name}").schema.fields
        if "binary" in f.dataType.simpleString()
    ]
    assert binary == []


def test_cut_bodies_make_the_same_prompts(spark):
    from ledgerflow.operators import prompts

    rows = spark.createDataFrame(
        [("s", "f", "x" * 9000, "<p>"), ("s", "f", "", "h" * 5000), ("s", "f", None, None)],
        "subject string, from_address string, body_text string, body_html string")
    for stage in ("classify", "extract"):
        whole = [r.prompt for r in prompts.with_prompt(rows, stage).collect()]
        assert whole == [r.prompt for r in prompts.with_prompt(prompts.cut_bodies(rows), stage).collect()]
    assert max(len(r.body_text) for r in prompts.cut_bodies(rows).collect()) == 4000


def test_arrivals_are_files_for_every_core(spark, sf_dir, tmp_path):
    # the whole table is one split; a stream parses a small file in one task
    run_queries.arrive(Inputs(spark, sf_dir), str(tmp_path), 0)
    read = spark.read.schema(run_queries.EVENTS).parquet(str(tmp_path))
    assert len(read.inputFiles()) >= spark.sparkContext.defaultParallelism
    wanted = Inputs(spark, sf_dir).table("events").filter(run_queries.arrival_of(F.col("event_id")) == 0)
    assert read.exceptAll(wanted).isEmpty() and wanted.exceptAll(read).isEmpty()
