"""Column functions on literal rows, one test per semantic trap."""

import datetime as dt
import hashlib

from pyspark.sql import functions as F

from casebook.config import FIXTURE_SETTINGS as FX
from casebook.functions import columns as C


def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def test_status_label_passes_other_values_and_null(spark):
    df = spark.createDataFrame([("in_progress",), ("on_hold",), ("closed",), (None,)], "s string")
    out = rows(df.select(C.status_label("s", FX.status_remap).alias("x")), "x")
    assert out == [("pending_customer",), ("pending_engineering",), ("closed",), (None,)]


def test_plan_category_first_tag_or_default(spark):
    df = spark.createDataFrame([([{"name": "A", "tier": None}, {"name": "B", "tier": None}],), ([],), (None,)],
                               "tags array<struct<name:string,tier:string>>")
    assert rows(df.select(C.plan_category("tags", "PAYG").alias("x")), "x") == [("A",), ("PAYG",), ("PAYG",)]


def test_assignee_blank_or_missing(spark):
    df = spark.createDataFrame([("",), (None,), ("ann",)], "n string")
    assert rows(df.select(C.assignee("n", "unassigned").alias("x")), "x") == [("unassigned",), ("unassigned",), ("ann",)]


def test_escalation_is_three_valued(spark):
    df = spark.createDataFrame([
        ("hi chat.staff.example", None),        # text match wins over NULL sender -> true
        ("plain", None),                        # NULL sender, no match -> NULL
        ("plain", "Agent2@Staff.example"),      # staff domain, case-insensitive -> true
        ("plain", "agent0@staff.example"),      # excluded -> false
        ("CHAT.STAFF.EXAMPLE", "c1@cust.example"),  # text match is case-sensitive -> false
        (None, "x@cust.example"),               # NULL text OR false -> NULL
    ], "t string, s string")
    flag = C.escalation_flag("t", "s", FX.chat_host, FX.staff_domain, FX.excluded_senders)
    assert [r[0] for r in df.select(flag).collect()] == [True, None, True, False, False, None]


def test_sender_falls_back_on_blank(spark):
    df = spark.createDataFrame([("", "b@x"), (None, "b@x"), ("a@x", "b@x")], "u string, s string")
    assert rows(df.select(C.sender("u", "s").alias("x")), "x") == [("b@x",), ("b@x",), ("a@x",)]


def test_label_variants_differ(spark):
    df = spark.createDataFrame([("c", "s"), ("c", None), (None, "s"), ("", ""), ("None", "s"), ("c", "None")],
                               "c string, s string")
    a = [r[0] for r in df.select(C.label_a("c", "s")).collect()]
    b = [r[0] for r in df.select(C.label_b("c", "s")).collect()]
    assert a == ["c - s", "c", "s", "", "None - s", "c - None"]
    assert b == ["c - s", "c", "", "", "", "c"]


def test_put_field_overwrites_and_keeps_others(spark):
    df = spark.createDataFrame([({"a": "1", "mig": "old"},), (None,)], "m map<string,string>")
    out = [r[0] for r in df.select(C.put_field("m", "mig", F.lit("new"))).collect()]
    assert out == [{"a": "1", "mig": "new"}, {"mig": "new"}]


def test_drop_blank_values(spark):
    df = spark.createDataFrame([({"a": "1", "b": "", "c": None},)], "m map<string,string>")
    assert df.select(C.drop_blank_values("m")).collect()[0][0] == {"a": "1"}


def _py_link_ts(ts):
    try:
        return f"{float(ts):.6f}".rstrip("0").rstrip(".")
    except (ValueError, TypeError):
        return str(ts)


def test_link_timestamp_matches_python(spark):
    vals = ["1700000123.000123", "1700000100.000100", "1701000000.000000", " 12.5 ", "1e3", "abc", "12d", "1_0",
            "0.0000004", "1700000000.1234567"]
    df = spark.createDataFrame([(v,) for v in vals], "t string")
    got = [r[0] for r in df.select(C.link_timestamp("t")).collect()]
    exp = [_py_link_ts(v) if v not in ("12d", "1_0") else v for v in vals]
    assert got == exp


def test_hash_bucket_matches_hashlib(spark):
    vals = [f"C{i % 50}{1700000000 + i}.{i:06d}" for i in range(300)] + ["", "é-ü"]
    df = spark.createDataFrame([(v,) for v in vals], "t string")
    for m in (10, 7, 1000):
        got = [r[0] for r in df.select(C.hash_bucket("t", m)).collect()]
        assert got == [int(hashlib.md5(v.encode()).hexdigest(), 16) % m for v in vals]


def test_preview(spark):
    df = spark.createDataFrame([("x" * 101,), ("y" * 100,), (None,)], "t string")
    out = [r[0] for r in df.select(C.preview("t", 100)).collect()]
    assert out == ["x" * 100 + "...", "y" * 100, None]


def test_strict_date_accepts_unpadded_only_valid(spark):
    df = spark.createDataFrame([("2024-3-1",), ("2024-03-20",), ("invalid-date",), ("2024-13-01",)], "t string")
    out = [r[0] for r in df.select(C.strict_date("t")).collect()]
    assert out == [dt.date(2024, 3, 1), dt.date(2024, 3, 20), None, None]


def test_age_days_and_week(spark):
    df = spark.createDataFrame([("closed", dt.date(2024, 3, 5), dt.date(2024, 3, 1)),
                                ("open", None, dt.date(2024, 12, 30))], "s string, c date, d date")
    out = df.select(C.age_days("s", "c", "d", dt.date(2025, 1, 1)), C.week_start("d")).collect()
    assert [tuple(r) for r in out] == [(4, dt.date(2024, 2, 26)), (2, dt.date(2024, 12, 30))]
