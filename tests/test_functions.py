from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from dqloom.functions import fixed_values as fixed
from dqloom.functions import naming, numbers, text, timewindow


def column(spark, values, ddl, expression):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {ddl}")
    return [r[0] for r in frame.orderBy("i").select(expression(F.col("v"))).collect()]


def test_percentages_round_like_ieee_decimal_rounding(spark):
    rng = random.Random(1)
    pairs = [(1, 32), (3, 32), (107, 4000), (25953, 60000), (0, 0), (5, 0), (7, 7)]
    pairs += [(rng.randint(0, t), t) for t in rng.choices((800, 4000, 60000, 7, 32), k=3000)]
    frame = spark.createDataFrame(pairs, "part long, total long")
    found = frame.select(
        "part", "total",
        numbers.pct(F.col("part"), F.col("total")).alias("two"),
        numbers.pct(F.col("part"), F.col("total"), 1).alias("one"),
        numbers.fixed_text(numbers.share(F.col("part"), F.col("total")), 2).alias("text"),
    ).collect()
    for row in found:
        exact = row.part / row.total * 100 if row.total else None
        assert row.two == (0.0 if exact is None else round(exact, 2))
        assert row.one == (0.0 if exact is None else round(exact, 1))
        if exact is not None:
            assert row.text == f"{exact:.2f}"


def test_clean_cell(spark):
    cells = ["a\x00b\x1fc\x85d", "a\r\nb\rc\nd", "tab\tstays", None, "x" * 600, "\x0b\x0c\x0e\x7f"]
    assert column(spark, cells, "string", text.clean_cell) == [
        "abcd", "a b c d", "tab\tstays", None, "x" * 500, "",
    ]
    whole = column(spark, ["y" * 600], "string", lambda v: text.clean_cell(v, None))
    assert whole == ["y" * 600]


def test_mask_sample(spark):
    samples = ["Nguyen | An | Ba", "ab", "abc", " spaced  |  out ", "", None]
    assert column(spark, samples, "string", text.mask_sample) == [
        "Ng*** | *** | ***", "***", "ab***", "sp*** | ou***", "***", None,
    ]


def test_tokens_are_whole_and_parts_are_substrings(spark):
    names = ["user_log", "blog_post", "catalog", "logistics", "LOG", "sys_x", "xsys_"]
    keywords = dict(fixed.TIER_KEYWORDS)
    assert column(spark, names, "string", naming.suggested_tier) == [3, None, 2, None, 3, 2, None]
    assert column(spark, names, "string", naming.is_excluded_table) == [
        True, True, True, True, True, False, False,
    ]
    assert keywords[3][0] == "log"
    assert column(spark, ["a"], "string", lambda v: naming.has_token(v, ["", ""])) == [False]


def test_tiers(spark):
    values = ["1", "2", " 3 ", "4", "0", "tier 1", "1.0", "Nhóm 1", None, "x"]
    assert column(spark, values, "string", naming.normalized_tier) == [
        1, 2, 3, None, None, None, None, None, None, None,
    ]
    assert column(spark, values, "string", naming.is_tier_one) == [
        True, False, False, False, False, True, True, True, False, False,
    ]


def test_schema_purpose_takes_the_first_match(spark):
    names = ["event_log", "events", "STG_x", "his", "old_data", "hr"]
    assert column(spark, names, "string", naming.schema_purpose) == [
        "audit", "log", "staging", "production", "archive", "production",
    ]


def test_table_label_is_ordered_and_replaceable(spark):
    assert column(spark, ["orders"], "string", lambda v: naming.table_label(v, ())) == ["system"]
    own = (("first", ("log",)), ("second", ("catalog",)))
    assert column(spark, ["catalog"], "string", lambda v: naming.table_label(v, own, "none")) == [
        "first"
    ]


def test_personal_columns(spark):
    names = ["HO_TEN", "fullname", "e_mail", "telemetry", "id_card", "amount", "secret"]
    found = column(
        spark, names, "string",
        lambda v: naming.is_personal(F.lit("s"), F.lit("t"), v, extra=["s.t.secret"]),
    )
    expected = [
        bool(re.search("|".join(fixed.PII_PATTERNS), n, re.I)) or n == "secret" for n in names
    ]
    assert found == expected == [True, True, True, True, True, False, True]


def test_null_class_and_warning(spark):
    assert column(spark, ["ngay_tao", "Ghi_Chu", "ngaytao"], "string", naming.null_class) == [
        "Conditional NULL", "Conditional NULL", None,
    ]
    cases = [(5.0, "1"), (5.1, "1"), (90.0, "2"), (90.1, "3"), (99.0, "need_check"), (None, "1"),
             (99.0, None)]
    frame = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, p double, t string")
    found = frame.orderBy("i").select(naming.null_warning(F.col("p"), F.col("t"))).collect()
    assert [r[0] for r in found] == ["OK", "CRITICAL", "OK", "SUSPECT", "OK", "OK", "OK"]


def test_technical_columns(spark):
    cases = [("x", "int", True, True), ("x", "timestamp_ntz", False, True), ("x", "date", False, False),
             ("ID", "int", False, True), ("patient_ID", "int", False, True),
             ("idx", "int", False, False), ("my_created_at_x", "string", False, True),
             ("paid", "timestamp without time zone", None, True), ("v", "decimal(8,2)", None, False)]
    frame = spark.createDataFrame(cases, "c string, t string, pk boolean, want boolean")
    wrong = frame.filter(
        naming.is_technical_column(F.col("c"), F.col("t"), F.col("pk")) != F.col("want")
    )
    assert wrong.count() == 0


@pytest.mark.parametrize("type_name, values, dirty", [
    ("string", ["", " N/A ", "\tx", "X", ".", "unknown", "ok", "0"],
     [True, True, False, True, True, True, False, False]),
    ("int", [0, -1, 9999, 1], [True, True, True, False]),
    ("double", [0.0, -1.0, 9999.0], [False, False, False]),
    ("boolean", None, None),
])
def test_dirty_by_type(spark, type_name, values, dirty):
    if values is None:
        assert naming.is_dirty(F.col("v"), type_name) is None
        return
    assert column(spark, values, type_name, lambda v: naming.is_dirty(v, type_name)) == dirty


def test_dirty_number_by_value(spark):
    found = column(
        spark, [0.0, -1.0, 2.0], "double", lambda v: naming.is_dirty(v, "double", by_value=True)
    )
    assert found == [True, True, False]


def test_references(spark):
    values = ["s.t", "s.", "t", "a.b.c", None, "."]
    errors = column(spark, values, "string", lambda v: text.reference_error(v, 2))
    assert [e is None for e in errors] == [True, False, False, False, False, False]


def test_compact_key_tells_long_texts_apart(spark):
    values = ["a" * 64, "a" * 65, "a" * 66, "short", None, "é" * 40]
    keys = column(spark, values, "string", lambda v: text.compact_key(v, True))
    assert keys[0] == "a" * 64 and keys[3] == "short" and keys[4] is None
    assert len({k for k in keys if k}) == 5
    assert all(len(k) == 71 for k in (keys[1], keys[2], keys[5]))


def test_window_bounds(spark):
    texts = ["2025-01-01", "2025-01-01 10:00:00", "01/02/2025", "", None]
    start = column(spark, texts, "string", lambda v: timewindow.window_bound(v).cast("string"))
    end = column(spark, texts, "string", lambda v: timewindow.window_bound(v, True).cast("string"))
    assert start == ["2025-01-01 00:00:00", "2025-01-01 10:00:00", None, None, None]
    assert end == ["2025-01-01 23:59:59", "2025-01-01 10:00:00", None, None, None]


def test_calendar_months(spark):
    found = spark.sql("SELECT DATE'2025-01-01' AS a, DATE'2026-05-31' AS b").select(
        numbers.months_inclusive(F.col("a"), F.col("b"))
    )
    assert found.first()[0] == 17


def test_elapsed_seconds_ignore_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        found = spark.sql(
            "SELECT TIMESTAMP_NTZ'2024-03-10 01:30:00.25' AS a, TIMESTAMP_NTZ'2024-03-10 03:30:00' AS b"
        ).select(timewindow.elapsed_seconds(F.col("a"), F.col("b"))).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert found == 7199.75
