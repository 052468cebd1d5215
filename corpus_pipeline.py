"""A corpus pipeline: quality, near duplicates, repeated passages, benchmark leaks, packing.

Every stage takes all documents its predecessor kept; all but the last return the columns
of ``documents``.  Components are named by ids, so rows with a null ``doc_id`` leave with the
first stage.  Other defined results are those of the operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm.common import staged, table
from ledgerflow.llm.decontamination import contaminated_words
from ledgerflow.llm.near_dedup import near_duplicates
from ledgerflow.llm.packing import packed
from ledgerflow.llm.quality import quality_scores
from ledgerflow.llm.substring_dedup import without_repeats
from ledgerflow.session import TEXT_SETTINGS, configure

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose quality score reaches the threshold."""
    configure(spark, TEXT_SETTINGS)
    scores = quality_scores(docs, table(spark, sf_dir, "labels"), carry=COLUMNS[1:])
    return scores.filter("predicted = 1 and doc_id is not null").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of least id; of repeated rows one.

    Rows of one id with different texts are decided each.
    """
    configure(spark, TEXT_SETTINGS)
    key = ["doc_id", "text_key"]
    docs = docs.select(*COLUMNS)
    found = staged(near_duplicates(docs, size=5, percent=80, keyed=True), "pipeline-near")
    docs = docs.withColumn("text_key", F.xxhash64("text"))
    dropped = found.filter(~F.col("kept")).select(*key).distinct()
    repeated = found.groupBy(*key).count().filter("count > 1").select(*key)
    once = docs.join(dropped.unionByName(repeated).distinct(), key, "left_anti")
    again = docs.join(repeated.join(dropped, key, "left_anti"), key, "left_semi")
    return once.unionByName(again.dropDuplicates(["doc_id", "text"])).select(*COLUMNS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without passages of 50 words that an earlier one has.

    A text that loses words is left as its other words, joined by one space; a document
    that loses all of them goes.
    """
    configure(spark, TEXT_SETTINGS)
    kept = without_repeats(docs, carry=["text", "lang", "source", "n_chars"])
    changed = F.col("n_removed") > 0
    text = F.when(changed, F.col("kept_text")).otherwise(F.col("text"))
    size = F.when(changed, F.length("kept_text").cast("long")).otherwise(F.col("n_chars"))
    return kept.filter(~changed | (F.col("kept_text") != "")).select(
        "doc_id", text.alias("text"), "lang", "source", size.alias("n_chars"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that share no window of words with the benchmark; each row is decided."""
    configure(spark, TEXT_SETTINGS)
    # a row goes by its id and text together, for an id may stand on rows of different texts
    docs = docs.select(*COLUMNS, F.xxhash64("doc_id", "text").alias("row_key"))
    found = contaminated_words(docs.select(F.col("row_key").alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    leaks = found.filter("n_hit > 0").select(F.col("doc_id").alias("row_key")).distinct()
    return docs.join(leaks, "row_key", "left_anti").select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of 2048 ids."""
    import public_tokenizers

    configure(spark, TEXT_SETTINGS)
    return packed(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=1)


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontaminate", decontaminate),
    ("pack", pack),
]

# models and token ids are beyond SQL; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
