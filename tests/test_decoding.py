"""Strict and lax typing of model answers."""

import json
import math
from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerflow.operators import decoding as dc


def classify(spark, answers, subject="hello"):
    frame = spark.createDataFrame(
        [(k, subject, a) for k, a in enumerate(answers)], "k int, subject string, response string"
    )
    return {r.k: r for r in dc.decode_classification(frame).collect()}


def extract(spark, answers):
    frame = spark.createDataFrame([(k, a) for k, a in enumerate(answers)], "k int, response string")
    return {r.k: r for r in dc.decode_invoice(frame).collect()}


def field(spark, name, values):
    """The decoded field per raw JSON value; ``"void"`` where the invoice is void."""
    got = extract(spark, ["{" + f'"{name}": {v}' + "}" for v in values])
    return [
        got[k].invoice[name] if got[k].extract_error is None
        else "void" if got[k].extract_error == dc.NO_EXTRACTION else "too large"
        for k in range(len(values))
    ]


def test_lax_truth_values(spark):
    yes = ["true", '"yes"', '"Y"', '"ON"', '"t"', '"1"', "1", "1.0"]
    no = ["false", '"no"', '"N"', '"off"', '"F"', '"0"', "0", "0.0"]
    bad = ["2", '"maybe"', "null", "[]", '""', "-1", '" yes"']
    got = classify(spark, ['{"is_invoice": ' + v + "}" for v in yes + no + bad], "a bill")
    for k in range(len(yes)):
        assert got[k].is_invoice and not got[k].fallback
    for k in range(len(yes), len(yes + no)):
        assert not got[k].is_invoice and not got[k].fallback
    for k in range(len(yes + no), len(yes + no + bad)):
        assert got[k].fallback and got[k].is_invoice and got[k].confidence == "low"


def test_classification_shapes(spark):
    answers = [
        '{"is_invoice": true, "confidence": "high", "reasoning": "r"',
        '{"is_invoice": true, "confidence": 1}',
        '{"is_invoice": true, "reasoning": null, "more": [1]}',
        '{"is_invoice": true, "is_invoice": false}',
        '[true]',
        '{"is_invoice": true} and more',
        "",
        None,
        '{"is_invoice": NaN}',
        '{"is_invoice": true}}',
    ]
    got = classify(spark, answers)
    assert (got[0].is_invoice, got[0].confidence, got[0].reasoning) == (True, "high", "r")
    assert got[1].fallback and not got[1].is_invoice
    assert (got[2].is_invoice, got[2].confidence, got[2].reasoning) == (True, None, None)
    assert got[3].is_invoice is False and not got[3].fallback
    assert all(got[k].fallback for k in (4, 5, 6, 7, 8, 9))
    assert got[7].reasoning == "Fallback classification (error: no response)"


def test_call_error_falls_back(spark):
    frame = spark.createDataFrame(
        [("Payment due", None, "time out")], "subject string, response string, error string"
    )
    row = dc.decode_classification(frame).first()
    assert row.is_invoice and row.reasoning == "Fallback classification (error: time out)"


def test_amounts(spark):
    values = [
        "1.005", '"1.005"', "1.004", "99999999.99", "100000000", "99999999.995", '"12abc"', "true",
        '" 12 "', '"1_000.5"', '"1e3"', "1e3", '"$12"', '""', "null", "-3.335", '"NaN"', "[1]", "{}",
        '"+.5"', "12345678", '"Infinity"',
    ]
    d = Decimal
    assert field(spark, "total_amount", values) == [
        d("1.01"), d("1.01"), d("1.00"), d("99999999.99"), "too large", "too large", "void", "void",
        d("12.00"), d("1000.50"), d("1000.00"), d("1000.00"), "void", "void", None, d("-3.34"),
        "void", "void", "void", d("0.50"), d("12345678.00"), "void",
    ]


def test_due_dates(spark):
    values = [
        '"2024-02-03"', '"2024-02-30"', '"2024-02-03T10:20:30Z"', '"2024-02-03 10:20"',
        '"2024-02-03T10:20:30.5+05:30"', '"2024-02-03t10:20:30-0100"', "1700000000",
        "1700000000000", '"1700000000"', "1700000000.25", '""', '"null"', '"Feb 3, 2024"', "true",
        "null", '"2024-2-3"', '"2024-02"', "[]", '"0000-01-01"', '" 2024-02-03"', "1e30",
    ]

    def t(*parts):
        return datetime(*parts)

    assert field(spark, "due_date", values) == [
        t(2024, 2, 3), "void", t(2024, 2, 3, 10, 20, 30), t(2024, 2, 3, 10, 20),
        t(2024, 2, 3, 4, 50, 30, 500000), t(2024, 2, 3, 11, 20, 30), t(2023, 11, 14, 22, 13, 20),
        t(2023, 11, 14, 22, 13, 20), t(2023, 11, 14, 22, 13, 20), t(2023, 11, 14, 22, 13, 20, 250000),
        "void", "void", "void", "void", None, "void", "void", "void", "void", "void", "void",
    ]


def test_texts_are_strict(spark):
    values = ['"INV-1"', "17", "true", "null", "[]", '""']
    expected = ["INV-1", "void", "void", None, "void", ""]
    for name in ("invoice_number", "vendor_name", "payment_status"):
        assert field(spark, name, values) == expected


def test_currency_default_needs_an_absent_key(spark):
    got = extract(spark, ["{}", '{"currency": null}', '{"currency": "EUR"}', '{"currency": 3}'])
    assert [got[k].invoice and got[k].invoice.currency for k in range(4)] == [
        "USD", None, "EUR", None,
    ]
    assert got[3].extract_error == dc.NO_EXTRACTION


def test_whole_answer_must_be_one_object(spark):
    answers = ["[1]", '"x"', "12", "", "{", '{"a": 1} x', '{"a": 1},{"b": 2}', '{"a": 1}]', "null", None]
    got = extract(spark, answers)
    assert all(r.extract_error == dc.NO_EXTRACTION and r.invoice is None for r in got.values())


def test_line_items(spark):
    items = [
        ({"description": "a", "quantity": 2, "unitPrice": 1.5}, ("a", 2.0, Decimal("1.5"))),
        ({"description": "b", "unit_price": "2.25"}, ("b", None, Decimal("2.25"))),
        ({"description": "c", "unit_price": 1, "unitPrice": 2}, ("c", None, Decimal(1))),
        ({"description": "d", "unit_price": None, "unitPrice": 2}, ("d", None, None)),
        ({"description": "e", "unit_price": 1, "unitPrice": "x"}, None),
        ({"description": "f", "quantity": "3.5", "more": {}}, ("f", 3.5, None)),
        ({"description": "g", "quantity": True}, ("g", 1.0, None)),
        ({"description": "h", "quantity": "many"}, None),
        ({"description": 5}, None),
        ({"quantity": 1}, None),
        ({"description": None}, None),
        ({"description": "i", "unitPrice": True}, None),
        ({"description": "j", "quantity": None, "unitPrice": None}, ("j", None, None)),
        ({"description": "k", "unitPrice": 1.23456789}, ("k", None, Decimal("1.23456789"))),
        ({"description": "l", "unitPrice": 1e30}, ("l", None, Decimal("1e30"))),
        ({"description": "m", "unitPrice": 1e-20}, ("m", None, Decimal("1e-20"))),
        ({"description": "n", "unitPrice": "1." + "7" * 25}, ("n", None, Decimal("1." + "7" * 25))),
        ({"description": "o", "unitPrice": "1e999"}, None),
        ({"description": "p", "quantity": "1e999"}, None),
        ({"description": "", "quantity": []}, None),
        ("text", None),
        (None, None),
        (["description"], None),
    ]
    got = extract(spark, [json.dumps({"line_items": [item for item, _ in items]})])[0]
    found = [
        (i.description, i.quantity, None if i.unit_price is None else Decimal(i.unit_price))
        for i in got.invoice.line_items
    ]
    assert found == [wanted for _, wanted in items if wanted]


def test_numbers_beyond_all_doubles(spark):
    answer = '{"line_items": [{"description": "a", "quantity": 1e999}, {"description": "b", "unitPrice": 1e999}]}'
    assert extract(spark, [answer])[0].invoice.line_items == []


def test_line_items_that_are_no_list(spark):
    got = extract(spark, ['{"line_items": "x"}', '{"line_items": null}', '{"line_items": {"a": 1}}', "{}"])
    assert all(r.invoice.line_items == [] for r in got.values())


def test_json_keeps_nulls_and_reads_both_spellings(spark):
    frame = spark.createDataFrame(
        [([("a", None, "1.50")],)],
        "items array<struct<description string, quantity double, unit_price string>>",
    )
    text = frame.select(dc.line_items_json(F.col("items")).alias("t"))
    assert text.first().t == '[{"description":"a","quantity":null,"unit_price":1.5}]'
    other = '[{"description":"b","quantity":1,"unitPrice":2.5}]'
    both = text.union(spark.createDataFrame([(other,)], "t string"))
    back = [r[0][0] for r in both.select(dc.read_line_items_json(F.col("t"))).collect()]
    assert [(i.description, i.quantity, float(i.unit_price)) for i in back] == [
        ("a", None, 1.5), ("b", 1.0, 2.5),
    ]
    files = spark.createDataFrame([('[{"fileName":"f","fileKey":"k"}]',)], "t string")
    assert tuple(files.select(dc.read_attached_files_json(F.col("t"))).first()[0][0]) == ("f", "k")


def test_session_zone_does_not_move_dates(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        frame = spark.createDataFrame([('{"due_date": "2024-02-03"}',)], "response string")
        seconds = dc.decode_invoice(frame).select(F.unix_seconds("invoice.due_date")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert seconds == math.floor((datetime(2024, 2, 3) - datetime(1970, 1, 1)).total_seconds())


def test_the_error_alone_needs_no_line_items(spark):
    """Who counts errors has no item decoded; who asks for items has each number read in one step."""
    frame = spark.createDataFrame([(1, '{"total_amount": "x"}'), (2, "{}")], "k int, response string")
    decoded = dc.decode_invoice(frame)
    errors = decoded.select("k", "extract_error")
    assert "line_items" not in errors._jdf.queryExecution().optimizedPlan().toString()
    assert {r.k: r.extract_error for r in errors.collect()} == {1: dc.NO_EXTRACTION, 2: None}
    items = decoded.select("invoice.line_items")._jdf.queryExecution().optimizedPlan().toString()
    # the total, quantity, price and shadowed price: each read once, and a reading names its pattern twice
    patterns = items.count("eE][+-]?")
    assert 0 < patterns <= 2 * 4
