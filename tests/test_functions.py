"""Scalar helpers on hand-made values."""

import datetime as dt
import hashlib
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from funnelry.functions import documents, repair, values


def column(spark, inputs, build, schema="v string"):
    df = spark.createDataFrame([(n, x) for n, x in enumerate(inputs)], f"n int, {schema}")
    return [r.out for r in df.select("n", build(F.col("v")).alias("out")).orderBy("n").collect()]


def test_money(spark):
    texts = ["$1,200.505", "", None, "abc", "1-2", "-5", "0", " 7 "]
    assert column(spark, texts, values.money) == [
        Decimal("1200.51"),
        None,
        None,
        None,
        None,
        Decimal("-5.00"),
        Decimal("0.00"),
        Decimal("7.00"),
    ]


def test_timestamp_keeps_the_wall_clock(spark):
    texts = ["2026-05-16 07:30:00", "2026-05-16T07:30:00+05:00", "", "soon", None]
    at = dt.datetime(2026, 5, 16, 7, 30)
    assert column(spark, texts, values.timestamp) == [at, at, None, None, None]


def test_strict_timestamp_raises_on_unreadable_text(spark):
    assert column(spark, [""], values.strict_timestamp) == [None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        column(spark, ["soon"], values.strict_timestamp)


def test_local_date_follows_daylight_saving(spark):
    # New York is UTC-5 until 2026-03-08 07:00 UTC and UTC-4 from then on.
    times = [dt.datetime(2026, 3, 2, 3, 30), dt.datetime(2026, 3, 8, 4, 30), dt.datetime(2026, 3, 9, 4, 30)]
    local = column(spark, times, lambda c: values.local_date(c, "America/New_York"), "v timestamp_ntz")
    assert local == [dt.date(2026, 3, 1), dt.date(2026, 3, 7), dt.date(2026, 3, 9)]
    utc = column(spark, times, values.utc_date, "v timestamp_ntz")
    assert utc == [dt.date(2026, 3, 2), dt.date(2026, 3, 8), dt.date(2026, 3, 9)]


def test_capture_tells_absent_from_empty(spark):
    texts = ["'email': 'a@b'", "'email': ''", "'phone': '1'", None]
    found = column(spark, texts, lambda c: values.capture(c, "'email': '([^']*)'"))
    assert found == ["a@b", "", None, None]


def test_split_list_text(spark):
    texts = ['["Logistical", "Money"]', "[]", "Money", " a ,  b0 ,c1"]
    found = column(spark, texts, values.split_list_text)
    assert found == [["Logistical", "Money"], [""], ["Money"], ["a", "b0", "c1"]]


def test_ratio_is_null_without_divisor(spark):
    df = spark.createDataFrame([(1, 3), (1, 0), (None, 2), (1, 32)], "a bigint, b bigint")
    found = [r.r for r in df.select(values.ratio("a", "b", 4).alias("r")).collect()]
    assert found == [0.3333, None, None, 0.0313]
    zero = df.select(values.ratio_or_zero(F.col("a"), F.col("b")).alias("r")).collect()
    assert [r.r for r in zero] == [1 / 3, 0.0, 0.0, 1 / 32]


def test_joined_key_needs_every_part(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None)], "x string, y string")
    keys = [r.k for r in df.select(values.joined_key(F.col("x"), F.col("y")).alias("k")).collect()]
    assert keys[0] == hashlib.md5(b"a|b").hexdigest()
    assert keys[1] is None


def test_row_hash_tells_null_from_empty(spark):
    df = spark.createDataFrame([("", "x"), (None, "x")], "a string, b string")
    hashes = {r.h for r in df.select(values.row_hash("a", "b").alias("h")).collect()}
    assert len(hashes) == 2


def test_document_paths_with_dots(spark):
    doc = '{"custom.cf_x": "1", "custom": {"cf_x": "2"}, "gone": null, "list": ["a"], "n": 1.50}'
    df = spark.createDataFrame([(doc,)], "j string").select(F.parse_json("j").alias("d"))
    row = df.select(
        documents.text("d", "custom.cf_x").alias("dotted"),
        documents.text("d", "gone").alias("gone"),
        documents.present("d", "gone").alias("has_gone"),
        documents.present("d", "other").alias("has_other"),
        documents.text("d", "list").alias("list"),
        documents.json("d", "custom.cf_x").alias("quoted"),
        documents.json("d", "gone").alias("json_gone"),
        F.size(documents.items(documents.part("d", "list"))).alias("n_items"),
        documents.items("d").alias("no_items"),
    ).first()
    assert row.dotted == "1"
    assert row.gone is None and row.has_gone and not row.has_other
    assert row.list == '["a"]' and row.quoted == '"1"' and row.json_gone is None
    assert row.n_items == 1 and row.no_items is None


def test_repair_json(spark):
    texts = ["{'a': None, 'b': True, 'c': [False, 'None']}", "{'a': 'b'", "{\"ok\": 1}"]
    found = column(spark, texts, lambda c: F.to_json(repair.repair_json(c)))
    assert found == ['{"a":null,"b":true,"c":[false,"None"]}', None, '{"ok":1}']


ODD = [
    {"a": "it's"}, {"a": 'say "x"', "b": None, "c": True}, {"a": "both ' and \"q\"", "n": {"k": [1, 2.5, "d'e", False]}},
    {"t": "None of True, False: ok", "u": "tab\tnew\nback\\slash"}, {"é": "\x01", "x": "a\\"}, {}, {"l": [[], {}]},
    {"k": "x" * 20_000 + "'" + "y" * 9}, {"q": "'" * 3000}, {"a": "', 'b': '"}, {"a": "\\'"},
]


def test_printed_objects_come_back(spark):
    found = column(spark, [repr(x) for x in ODD], lambda c: F.to_json(repair.repair_json(c)))
    assert [json.loads(x) for x in found] == ODD


def test_reading_objects_counts_failures(spark):
    texts = [
        ('{"id": "it\'s"}', "it's", "parsed"), ("{'id': 'it's', 'b': 1}", "it's", "repaired"),
        ("{'b': 1, 'id': \"q's\", 'c'", "q's", "by_field"), ("{'id': 12, ", "12", "by_field"),
        ("{'id': None, ", None, "failed"), ("[1, 'a']", None, "failed"), ("  ", None, "blank"), (None, None, "blank"),
        ("{'idx': 3}", None, "repaired"), ("'i.d': 3", None, "failed"),
    ]
    rows = spark.createDataFrame([(i, t) for i, (t, *_) in enumerate(texts)], "i int, t string")
    read = repair.read_objects(rows, "t", ["id"], "o")
    found = [(r.o["id"], r.o["how"]) for r in read.orderBy("i").collect()]
    assert found == [tuple(x) for _, *x in texts]
    counts = repair.repair_profile(read, "o").first().asDict()
    assert counts == {"n_rows": 10, "n_blank": 2, "n_parsed": 1, "n_repaired": 2, "n_by_field": 2, "n_failed": 3}


def test_shuffle_partitions_follow_the_data():
    from funnelry.session import shuffle_partitions

    assert shuffle_partitions(10**9) == 200
    assert shuffle_partitions(10**12) == 1863
    assert shuffle_partitions(10**14) == 100_000
