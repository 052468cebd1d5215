"""The pipeline's stages, one after the other, against brute force."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from test_operators import brute_groups, brute_hits, brute_kept, corpus

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, node long, kept boolean"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A folder with documents, labels and a benchmark; some labels say that shouting is bad."""
    path = str(tmp_path_factory.mktemp("tables"))
    rng = random.Random(3)
    rows = [(i, t) for i, t in corpus(seed=5, count=90)]
    rows += [(2000 + k, " ".join(rng.choice(["THIS!!", "IS!!", "LOUD!!"]) for _ in range(40))) for k in range(30)]
    rows += [(None, "a text without id")]
    made = [(i, t, None if i and i % 9 == 0 else "en", None, len(t or ""), 1, True) for i, t in rows]
    spark.createDataFrame(made, DOCUMENTS).write.parquet(f"{path}/documents.parquet")
    labels = [(i, int(i < 2000), 0) for i, _ in rows if i is not None and i % 2 == 0]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    body = next(t for _, t in rows if t and 20 < len(t.split()) < 60)
    items = [(1, " ".join(body.split()[3:16])), (2, None), (3, "nothing like this is in any of the documents here at all")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def texts(docs):
    assert docs.columns == cp.COLUMNS
    return sorted((r.doc_id, r.text) for r in docs.collect())


def test_stages(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    good = cp.quality(spark, docs, tables)
    found = dict(texts(good))
    assert None not in found and not any(i >= 2000 for i in found)
    plain = {r.doc_id for r in docs.filter("doc_id < 500 and length(text) > 40").collect()}
    assert len(plain & set(found)) > 0.9 * len(plain)
    good = cp.staged(good, "test")

    rows = [(r.doc_id, r.text or "") for r in good.collect()]
    once = sorted({(d, t) for d, t in rows})
    kept = {d for d, _, _, k in brute_groups(rows, 5, 80) if k}
    near = cp.staged(cp.near_dedup(spark, good, tables), "test")
    assert [(d, t or "") for d, t in texts(near)] == [(d, t) for d, t in once if d in kept]

    rows = [(r.doc_id, r.text or "") for r in near.collect()]
    want = {d: (t if not gone else left) for (d, t), (_, _, gone, left) in zip(sorted(rows), brute_kept(rows, 50))
            if not gone or left}
    cut = cp.staged(cp.substring_dedup(spark, near, tables), "test")
    assert {d: t or "" for d, t in texts(cut)} == want

    rows = [(r.doc_id, r.text) for r in cut.collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()]
    clean = {d for d, _, hit, _ in brute_hits(rows, items, 10) if not hit}
    left = cp.staged(cp.decontaminate(spark, cut, tables), "test")
    assert {d for d, _ in texts(left)} == clean and len(clean) < len(rows)

    whole = cp.pack(spark, left, tables)
    sizes = whole.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    assert sizes.filter("n > 2048").isEmpty()
    assert {r.doc_id for r in whole.select("doc_id").distinct().collect()} == clean


def test_rows_of_one_id_are_decided_each(spark, tables):
    leak = spark.read.parquet(f"{tables}/benchmark.parquet").filter("item_id = 1").first().text
    copied, own = (" ".join(f"{w}{k}" for k in range(30)) for w in ("copied", "own"))
    rows = [(1, copied), (5, copied), (5, own), (5, own), (6, leak), (6, f"{own} more"), (7, leak + " and on")]
    docs = spark.createDataFrame([(i, t, "en", None, len(t), 1, True) for i, t in rows], DOCUMENTS)
    assert texts(cp.near_dedup(spark, docs.filter("doc_id < 6"), tables)) == [(1, copied), (5, own)]
    clean = [(i, t) for i, t in rows if leak not in t]
    assert texts(cp.decontaminate(spark, docs, tables)) == sorted(clean)


def test_run_on_tables_without_rows(spark, tables, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{tables}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert cp.run(spark, str(tmp_path)).collect() == []
