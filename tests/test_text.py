"""Cleaning of model answers: the ladder on hand-made texts."""

import pytest
from pyspark.sql import functions as F

from ledgerflow.functions.text import BLANKS, contains_any, repair_brace, strip
from ledgerflow.operators.decoding import with_clean_response

CASES = [
    ('{"a": 1}', '{"a": 1}'),
    ('  \n{"a": 1}　', '{"a": 1}'),
    ('```json\n{"a": {"b": 2}}\n```', '{"a": {"b": 2}}'),
    # the shortest object that is directly followed by the closing fence
    ('```json\n{"a": {"b": 2}\n}\n``` and ```\n{"c": 3}\n```', '{"a": {"b": 2}\n}'),
    ('```JSON\n{"a": 1}\n```', '{"a": 1}'),
    ('```\nno object\n```', "```\nno object\n```"),
    ('<think>{x}</think>{"a": 1}', '{"a": 1}'),
    ('<think>{x}</think> <think>y</think>\n so {"a": 1}.', '{"a": 1}'),
    # an open think block survives to the brace search
    ('<think>{x {"a": 1}', '{x {"a": 1}'),
    ('x</think>{"a": 1}', '{"a": 1}'),
    # starts with a brace: nothing is cut off behind it
    ('{"a": 1} as asked', '{"a": 1} as asked'),
    ('{"a": 1} ``` x', '{"a": 1}'),
    ("no json at all", "no json at all"),
    ("", ""),
    ("[1, 2]", "[1, 2]"),
    ('[{"a": 1}, {"b": 2}]', '{"a": 1}, {"b": 2}'),
    ('{"a": 1', '{"a": 1'),
    ('text {"a": 1', 'text {"a": 1'),
    ("<think>only</think>", ""),
    ("```json {\"a\": 1} ```", '{"a": 1}'),
]


def test_clean_response(spark):
    frame = spark.createDataFrame([(k, text) for k, (text, _) in enumerate(CASES)], "k int, response string")
    got = {r.k: r.cleaned for r in with_clean_response(frame).collect()}
    assert got == {k: cleaned for k, (_, cleaned) in enumerate(CASES)}


def test_null_response_stays_null(spark):
    frame = spark.createDataFrame([(None,)], "response string")
    assert with_clean_response(frame, repair=True).first().cleaned is None


def test_repair_brace(spark):
    frame = spark.createDataFrame([("{",), ("{}",), ("",)], "t string")
    assert [r[0] for r in frame.select(repair_brace(F.col("t"))).collect()] == ["{}", "{}", "}"]


def test_strip_equals_python(spark):
    texts = [BLANKS + "a b" + BLANKS, "\x1ca\x1f", "​a", "a﻿", "", BLANKS, "\x00 a"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in frame.select(strip(F.col("t"))).collect()] == [t.strip() for t in texts]


@pytest.mark.parametrize("subject, found", [
    ("Your INVOICE", True), ("unpaid", True), ("Billing info", True), ("prepayments", True),
    ("Receipt", True), ("hello", False), ("", False), ("in voice", False),
])
def test_keywords_are_substrings(spark, subject, found):
    frame = spark.createDataFrame([(subject,)], "s string")
    assert frame.select(contains_any(F.col("s"))).first()[0] is found
