"""Edge rows of the checks: NULLs, ties, empty tables, zero denominators."""

from __future__ import annotations

import math
import random
from datetime import date, datetime, timedelta
from decimal import Decimal, localcontext

import pytest
from pyspark.sql import functions as F

from dqloom.operators import completeness, consistency, growth, integrity, temporal, timeliness, uniqueness
from dqloom.operators import validity
from dqloom.sources.registry import TableRegistry


def registry(spark, **tables):
    found = TableRegistry(spark)
    for name, frame in tables.items():
        found.add("s", name, frame)
    return found


def test_orphans(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,), (3,)], "fk int")
    parent = spark.createDataFrame([(1,), (1,), (3,), (None,)], "id int")
    found = consistency.orphan_records(child, parent, [("fk", "id")]).first()
    assert tuple(found) == (4, 1, 25.0)
    fewer = consistency.orphan_records(child, parent.filter("id <> 1"), [("fk", "id")]).first()
    assert tuple(fewer) == (4, 3, 75.0)
    empty = consistency.orphan_records(child.limit(0), parent, [("fk", "id")]).first()
    assert tuple(empty) == (0, 0, 0.0)
    assert [r.fk for r in consistency.orphan_rows(child, parent, [("fk", "id")]).collect()] == [2]


def test_orphans_of_a_composite_key_ignore_partly_null_keys(spark):
    child = spark.createDataFrame([(1, "a"), (1, None), (None, "a"), (1, "b")], "x int, y string")
    parent = spark.createDataFrame([(1, "a"), (1, None)], "p int, q string")
    assert tuple(consistency.orphan_records(child, parent, [("x", "p"), ("y", "q")]).first()) == (
        2, 1, 50.0,
    )


def test_shared_checks_equal_single_ones(spark):
    """Keys of several types, sizes and sides in one plan; NULLs, -0.0, long texts, empty tables."""
    long = "x" * 5000
    child = spark.createDataFrame(
        [(1, 1.0, "a", 1), (2, -0.0, long, 2), (2, 0.0, "b", None), (None, None, None, 3), (4, 9.0, "", 4)],
        "i int, d double, t string, `odd.name` bigint",
    )
    parent = spark.createDataFrame(
        [(1, 0.0, long, 1), (2, 1.0, "b", 2), (2, 1.0, "a", 7), (None, None, None, None)],
        "i bigint, d double, t string, `odd.name` int",
    )
    tables = registry(spark, c=child, p=parent, empty=parent.filter("false"))
    pairs = [
        [("i", "i")], [("d", "d")], [("t", "t")], [("odd.name", "odd.name")], [("i", "odd.name")],
        [("i", "i"), ("t", "t")], [("t", "t"), ("i", "i"), ("odd.name", "i")], [("i", "i"), ("d", "d")],
    ]
    links = [((("s"), a), ("s", b), p) for p in pairs
             for a, b in [("c", "p"), ("p", "c"), ("c", "empty"), ("empty", "c"), ("c", "c")]]
    found = integrity.broken_link_checks(tables, links).collect()
    wanted = [
        (".".join(a), ".".join(b), ", ".join(f"{x} = {y}" for x, y in p),
         *consistency.orphan_records(tables.table(*a), tables.table(*b), p).first())
        for a, b, p in links
    ]
    assert sorted(tuple(r) for r in found) == sorted(wanted)
    uniques = [("s", t, f"{t}{i}", [c for c, _ in p]) for i, p in enumerate(pairs) for t in ("c", "p", "empty")
               if not (t != "c" and i == 6)]
    found = uniqueness.unique_checks(tables, uniques).collect()
    single = [tuple(uniqueness.duplicates(tables.table(s, t), s, t, c, n).first()) for s, t, n, c in uniques]
    assert sorted(tuple(r) for r in found) == sorted(single)


def test_odd_column_names(spark):
    """Names with dots, blanks and backticks pass through every kind of check."""
    child = spark.createDataFrame(
        [(1, "x", datetime(2024, 1, 1), datetime(2024, 2, 1)), (2, "N/A", datetime(2024, 3, 1), datetime(2024, 2, 1)),
         (None, None, None, None)],
        "`a.b` int, `t``x y` string, `from.created at` timestamp_ntz, `to``updated` timestamp_ntz",
    )
    parent = spark.createDataFrame([(1,), (None,)], "`p``q.r` bigint")
    tables = registry(spark, c=child, p=parent)
    rows = consistency.orphan_rows(child, parent, [("a.b", "p`q.r")]).collect()
    assert [r["a.b"] for r in rows] == [2] and rows[0].asDict().keys() == set(child.columns)
    rule = dict(id="r", table="s.c", start_column="from.created at", end_column="to`updated")
    assert consistency.date_order(tables, [rule]).first()["violation_count"] == 1
    dirty = {r["column_name"]: r["dirty_value_check"] for r in completeness.dirty_values(child, "s", "c").collect()}
    assert dirty["t`x y"]
    assert growth.best_timestamp_column(child, "s", "c").first()["value_count"] == 2
    assert growth.growth_rate(child, "s", "c").first()["note"].startswith("MIN_TO_MAX")
    checked = validity.validity_checks(child, [validity.ValidityRule("v", "a.b", "number_range", 2)])
    assert checked.first()["checked_count"] == 2


def test_repartitioning_and_doubling(spark):
    frame = spark.range(200).select((F.col("id") % 17).alias("fk"))
    parent = spark.range(9).withColumnRenamed("id", "pk")
    once = consistency.orphan_records(frame, parent, [("fk", "pk")]).first()
    again = consistency.orphan_records(frame.repartition(5), parent, [("fk", "pk")]).first()
    twice = consistency.orphan_records(frame.union(frame), parent, [("fk", "pk")]).first()
    assert once == again
    assert (twice[0], twice[1], twice[2]) == (2 * once[0], 2 * once[1], once[2])


def test_date_order_counts_equal_dates(spark):
    days = [(date(2024, 1, 1), date(2024, 1, 2)), (date(2024, 1, 2), date(2024, 1, 2)),
            (date(2024, 1, 3), date(2024, 1, 2)), (None, date(2024, 1, 2)), (date(2024, 1, 1), None)]
    tables = registry(spark, t=spark.createDataFrame(days, "a date, b date"))
    rule = dict(id="r", table="s.t", start_column="a", end_column="b")
    found = consistency.date_order(tables, [rule, {**rule, "id": "q", "operator": "<="}])
    assert {r.rule_id: tuple(r)[2:] for r in found.collect()} == {
        "r": (3, 2, 66.67), "q": (3, 1, 33.33),
    }


def test_total_detail(spark):
    headers = spark.createDataFrame(
        [(1, 10.0), (2, 5.0), (3, None), (4, 0.0), (None, 7.0), (None, 0.0), (2, 6.0)],
        "h int, total double",
    )
    details = spark.createDataFrame(
        [(1, 4.0), (1, 6.0), (2, 5.5), (2, None), (9, 1.0), (None, 7.0)], "d long, amount double"
    )
    exact = consistency.total_detail(headers, details, "total", "amount", [("h", "d")]).first()
    # differ: 5 and 6 against 5.5, 7 against nothing (a NULL key matches no detail)
    assert (exact.checked_count, exact.violation_count) == (6, 3)
    loose = consistency.total_detail(headers, details, "total", "amount", [("h", "d")], 0.5).first()
    assert loose.violation_count == 1
    none = consistency.total_detail(
        headers.limit(0), details, "total", "amount", [("h", "d")]
    ).first()
    assert tuple(none) == (0, 0, 0.0)


def test_double_totals_do_not_depend_on_row_order(spark):
    headers = spark.createDataFrame([(1, 0.3)], "k int, total double")
    details = spark.createDataFrame([(1, 0.1), (1, 0.2)], "k int, amount double")
    found = consistency.total_detail(headers, details, "total", "amount", [("k", "k")]).first()
    assert found.violation_count == 0


def test_whole_totals_of_details_with_cents(spark):
    rng = random.Random(1)
    totals = [(k, float(rng.randrange(10**7, 10**8))) for k in range(2000)]
    details = []
    for k, total in totals:
        part = Decimal(rng.randrange(1, 10**9)) / 100
        details += [(k, float(part)), (k, float(Decimal(total) - part))]
    headers = spark.createDataFrame(totals, "k int, total double")
    found = consistency.total_detail(headers, spark.createDataFrame(details, "k int, amount double"), "total", "amount", [("k", "k")])
    assert tuple(found.first()) == (2000, 0, 0.0)


@pytest.mark.parametrize("tolerance", [0.0, 4e-7, 0.01, 1e20])
def test_totals_are_those_of_decimals(spark, tolerance):
    rng = random.Random(2)
    pool = [0.1, -0.1, 1e23, -1e23, 1e-300, 1e300, -1e300, 4e-7, 5e-324, 123456.78, -0.0, 9999999.99, 1e7, 12345678901234567.0]
    totals, details, wrong = [], [], 0
    with localcontext() as context:
        context.prec = 1000
        for k in range(400):
            own = [rng.choice(pool) * rng.choice([1, 1, 3]) for _ in range(rng.randint(0, 5))]
            exact = sum((Decimal(repr(x)) for x in own), Decimal(0))
            totals.append((k, rng.choice([float(exact), 0.0, float(exact) + rng.choice([4e-7, 0.01, -0.01]), own[0] if own else 1.0])))
            details += [(k, x) for x in own]
        numbers = spark.createDataFrame([(x,) for x in {*(x for _, x in totals + details)}], "x double")
        written = {r.x: Decimal(r.text) for r in numbers.select("x", F.col("x").cast("string").alias("text")).collect()}
        limit = Decimal(repr(tolerance))
        for k, total in totals:
            wrong += abs(written[total] - sum((written[x] for i, x in details if i == k), Decimal(0))) > limit
    rng.shuffle(details)
    found = consistency.total_detail(
        spark.createDataFrame(totals, "k int, total double"),
        spark.createDataFrame(details, "k int, amount double").repartition(3), "total", "amount", [("k", "k")], tolerance,
    ).first()
    assert (found.checked_count, found.violation_count) == (400, wrong)


def test_limbs_hold_sums_of_many_rows(spark):
    """Bands as 10**10 rows of the largest limbs would leave them."""
    most = (consistency.BASE - 1) * 10**10
    terms = [(0, most), (1, most), (2, -most), (4, 1)]
    exact = sum(Decimal(u) * Decimal(10) ** (consistency.BAND * b) for b, u in terms)
    rows = [([(b, Decimal(u)) for b, u in part],) for part in (terms, [(b, -u) for b, u in terms], [], [(0, most), (0, -most)], [(-20, -1), (20, 1)], [(0, consistency.BASE), (1, -1)])]
    frame = spark.createDataFrame(rows, f"t array<{consistency.LIMB}>").coalesce(1)
    sign = 1 if exact > 0 else -1
    assert [r[0] for r in frame.select(consistency.sign_of(F.col("t"))).collect()] == [sign, -sign, 0, 0, 1, 0]


def test_odd_numbers_differ(spark):
    headers = spark.createDataFrame([(1, float("nan")), (2, float("inf")), (3, 1.0), (4, 0.0)], "k int, total double")
    details = spark.createDataFrame([(1, float("nan")), (2, float("inf")), (3, 1.0), (3, float("nan"))], "k int, amount double")
    found = consistency.total_detail(headers, details, "total", "amount", [("k", "k")], 1e300).first()
    assert (found.checked_count, found.violation_count) == (4, 3)


def test_status_terminal(spark):
    at = datetime(2024, 1, 1)
    events = spark.createDataFrame(
        [(1, "open", at, 1), (1, "closed", at, 2), (2, "open", at, 1), (None, "closed", at, 1),
         (None, "open", datetime(2024, 1, 2), 1), (3, None, at, 1), (4, "closed", None, 1)],
        "e int, s string, t timestamp_ntz, n int",
    )
    def check(**more):
        return tuple(
            consistency.status_terminal(events, ["e"], "s", "t", ["closed"], **more).first()
        )

    assert check(tie_breakers=["n"]) == (3, 2, 66.67)  # entity 1 is closed, 2 and NULL are open
    assert check() == (3, 3, 100.0)  # entity 1 ties on time: the greater status, "open", wins
    assert check(require_terminal=False, tie_breakers=["n"]) == (3, 0, 0.0)


def test_latest_status_tie(spark):
    at = datetime(2024, 1, 1)
    events = spark.createDataFrame([(1, "open", at), (1, "closed", at)], "e int, s string, t timestamp_ntz")
    assert consistency.latest_status(events, ["e"], "s", "t").first().status == "open"


def test_enum(spark):
    values = [("A",), ("a",), (" A",), (None,), ("B",), ("B",)]
    tables = registry(spark, t=spark.createDataFrame(values, "v string"),
                      e=spark.createDataFrame([], "v string"))
    rules = [dict(id="r", column="s.t.v", allowed_values=["A"]),
             dict(id="all", column="s.t.v", allowed_values=["A", "a", " A", "B"]),
             dict(id="empty", column="s.e.v", allowed_values=["A"])]
    found = {r.rule_id: tuple(r)[2:] for r in consistency.enum_checks(tables, rules).collect()}
    assert found == {
        "r": (5, 4, 3, 80.0), "all": (5, 0, 0, 0.0), "empty": (0, 0, 0, 0.0),
    }
    values = consistency.enum_invalid_values(tables, rules).select("rule_id", "value", "n").collect()
    assert sorted(map(tuple, values)) == [("r", " A", 1), ("r", "B", 2), ("r", "a", 1)]
    with pytest.raises(ValueError):
        consistency.enum_checks(tables, [dict(id="n", column="s.t.v", allowed_values=["A", None])])


def test_cross_table_null_policies(spark):
    parent = spark.createDataFrame([(1, "x"), (2, None), (3, "z"), (4, None), (None, "q")], "k int, v string")
    child = spark.createDataFrame([(1, "x"), (1, "y"), (2, None), (3, None), (9, "x"), (None, "q")],
                                  "k int, v string")
    def check(policy):
        return tuple(
            consistency.cross_table_check(parent, child, [("k", "k")], ("v", "v"), policy).first()
        )

    assert check("exclude_if_either_null") == (2, 1, 50.0)
    assert check("nulls_are_different") == (4, 2, 50.0)


def test_activity_after_closing(spark):
    def at(day):
        return datetime(2024, 1, day)

    events = spark.createDataFrame(
        [(1, "closed", at(2)), (1, "sale", at(1)), (1, "sale", at(3)), (2, "sale", at(9)),
         (None, "closed", at(1)), (None, "sale", at(2))],
        "e int, s string, t timestamp_ntz",
    )
    found = consistency.activity_after_closing(events, ["e"], "s", "t", ["closed"]).first()
    assert tuple(found) == (3, 1, 33.33)


def test_duplicates(spark):
    data = [("a", 1), ("a", 1), ("a", 1), ("b", 2), ("b", None), (None, None), ("c", 3), ("c", 3)]
    frame = spark.createDataFrame(data, "x string, y int")
    found = uniqueness.duplicates(frame, "s", "t", ["x", "y"]).first()
    assert tuple(found) == ("s", "t", "x, y", 6, 2, 5, 83.33)
    doubled = uniqueness.duplicates(frame.union(frame), "s", "t", ["x", "y"]).first()
    assert (doubled.checked_count, doubled.duplicate_row_count) == (12, 12)
    empty = uniqueness.duplicates(frame.limit(0), "s", "t", ["x"], "uq").first()
    assert tuple(empty) == ("s", "t", "uq", "x", 0, 0, 0, 0.0)
    with pytest.raises(ValueError):
        uniqueness.duplicates(frame, "s", "t", [])


def test_unaccented(spark):
    frame = spark.createDataFrame(
        [("Nguyễn  Văn Đạt",), ("nguyen van dat",), ("NGUYỄN VĂN ĐẠT",)], "n string"
    )
    found = {r[0] for r in frame.select(uniqueness.unaccented(F.col("n"))).collect()}
    assert found == {"nguyen van dat"}
    same = uniqueness.business_key_duplicates(
        frame, "s", "t", {"n": uniqueness.unaccented(F.col("n"))}
    ).first()
    assert same.duplicate_row_count == 3


def test_duplicate_impact(spark, rows):
    frame = spark.createDataFrame(
        [("a", 1), ("a", 2), ("b", 1), ("c", 2), ("c", 2), (None, 1)], "k string, m int"
    )
    found = uniqueness.duplicate_impact(frame, ["k"], F.col("m"))
    assert rows(found) == [(1, 2, 1, 50.0), (2, 3, 3, 100.0)]


def test_dirty_values(spark):
    frame = spark.createDataFrame(
        [("", 0, 0.0, Decimal("0.00"), datetime(1970, 1, 1, 5), True),
         (" x ", -1, 1.0, Decimal("1.00"), datetime(1900, 1, 1), None),
         ("N/A", 5, 2.0, Decimal("2.00"), datetime(2024, 1, 1), None)],
        "t string, i int, d double, m decimal(10,2), w timestamp_ntz, b boolean",
    )
    found = completeness.dirty_values(frame, "s", "t")
    assert {r.column_name: r.dirty_value_check for r in found.collect()} == {
        "t": "Failed: 3 value(s), 3 row(s) (100.00%)",
        "i": "Failed: 2 value(s), 2 row(s) (66.67%)",
        "d": "Pass", "m": "Pass", "b": "Pass",
        "w": "Failed: 2 value(s), 2 row(s) (66.67%)",
    }
    values = completeness.dirty_cells(frame).filter("column_name IN ('t', 'i')").collect()
    assert {(r.column_name, r.value, r.n) for r in values} == {
        ("t", "", 1), ("t", " x ", 1), ("t", "N/A", 1), ("i", "0", 1), ("i", "-1", 1)
    }
    empty = completeness.dirty_values(frame.limit(0), "s", "t").collect()
    assert {r.dirty_value_check for r in empty} == {"Pass"} and len(empty) == 6


def test_validity(spark):
    frame = spark.createDataFrame(
        [("a@b.co", "+84 912 345 678", 5, date(2024, 1, 1)), ("a@b", "12", 50, date(1899, 1, 1)),
         (None, None, None, None)], "e string, p string, n int, d date",
    )
    rules = [validity.ValidityRule("e", "e", "email"), validity.ValidityRule("p", "p", "phone"),
             validity.ValidityRule("n", "n", "number_range", high=9),
             validity.ValidityRule("d", "d", "date_range", date(1900, 1, 1))]
    found = validity.validity_checks(frame, rules).collect()
    assert [(r.rule_id, r.checked_count, r.violation_count) for r in found] == [
        ("e", 2, 1), ("p", 2, 1), ("n", 2, 1), ("d", 2, 1),
    ]
    with pytest.raises(ValueError):
        validity.ValidityRule("x", "e", "sound").broken()


def test_exact_percentiles(spark):
    values = sorted([3, 1, 4, 1, 5, 9, 2, 6, 5, 3, 5, 8, 100, 1000, -50])
    frame = spark.createDataFrame([(v,) for v in values], "v int")
    found = timeliness.exact_percentiles(
        frame, F.col("v"), {"lo": 0.0, "q1": 0.25, "half": 0.5, "all": 1.0}
    )
    assert {r.name: r.value for r in found.collect()} == {
        "lo": -50, "q1": values[3], "half": values[7], "all": 1000,
    }


def test_percentiles_of_close_values(spark):
    frame = spark.range(1, 101).select(F.col("id").alias("v"))
    shares = {f"p{i}": i / 100 for i in range(1, 101)}
    found = timeliness.exact_percentiles(frame, F.col("v"), shares)
    assert {r.name: r.value for r in found.collect()} == {f"p{i}": i for i in range(1, 101)}


def test_percentiles_of_the_whole_range(spark):
    rng = random.Random(4)
    values = [rng.randrange(-(2**63), 2**63) for _ in range(3000)] + [rng.randrange(100) for _ in range(3000)] + [7] * 2000
    values = sorted([*values, -(2**63), 2**63 - 1])
    frame = spark.createDataFrame([(v,) for v in values] + [(None,)] * 5, "v long").repartition(4)
    shares = {"lo": 0.0, "q1": 0.25, "half": 0.5, "q3": 0.75, "top": 0.999, "all": 1.0}
    found = timeliness.exact_percentiles(frame, F.col("v"), shares)
    assert {r.name: r.value for r in found.collect()} == {
        name: values[max(1, math.ceil(len(values) * Decimal(str(p)))) - 1] for name, p in shares.items()
    }
    assert timeliness.exact_percentiles(frame.where("v IS NULL"), F.col("v"), shares).count() == 0
    same = timeliness.exact_percentiles(spark.range(50).select(F.lit(3).alias("v")), F.col("v"), {"half": 0.5})
    assert [tuple(r) for r in same.collect()] == [("half", 3)]


def test_gaps_and_frequency(spark):
    days = [(date(2024, 1, d),) for d in (1, 1, 2, 5, 9)] + [(None,)]
    found = timeliness.coverage_gaps(spark.createDataFrame(days, "d date"), "d").first()
    assert tuple(found) == ("2024-01-01", "2024-01-09", 4, 2, 4)


def test_chain_completeness_and_links(spark):
    a = spark.createDataFrame([(1,), (2,), (3,)], "a int")
    b = spark.createDataFrame([(10, 1), (11, 1), (12, 2), (13, None)], "b int, a int")
    c = spark.createDataFrame([(10,), (None,), (13,)], "b int")
    found = integrity.chain_completeness(
        a, [integrity.Link(b, (("a", "a"),)), integrity.Link(c, (("b", "b"),))]
    ).first()
    assert tuple(found) == (3, 1, 2, 66.67)
    with pytest.raises(ValueError):
        integrity.chain_completeness(a, [])
    assert tuple(integrity.broken_links(b, c, [("b", "b")]).first()) == (4, 2, 50.0)


def test_intervals_and_transitions(spark, rows):
    def at(day):
        return datetime(2024, 1, day)

    intervals = spark.createDataFrame(
        [(1, at(1), at(20)), (1, at(2), at(3)), (1, at(5), at(6)), (1, at(25), at(24)),
         (2, at(1), at(2)), (2, at(2), at(3)), (None, at(1), at(9)), (None, at(2), at(3))],
        "k int, a timestamp_ntz, b timestamp_ntz",
    )
    found = temporal.interval_problems(intervals, ["k"], "a", "b").first()
    assert tuple(found) == (8, 3, 1, 37.5)
    states = spark.createDataFrame(
        [(1, at(1), "new"), (1, at(2), "done"), (1, at(3), "new"), (1, at(4), "new"),
         (2, at(1), "new")], "k int, t timestamp_ntz, s string",
    )
    steps = temporal.transitions(states, ["k"], "t", [], "s")
    assert rows(steps) == [("done", "new", 1), ("new", "done", 1), ("new", "new", 1)]
    allowed = spark.createDataFrame([("new", "done"), ("new", "new")], "from_status string, to_status string")
    assert rows(temporal.illegal_transitions(steps, allowed)) == [("done", "new", 1)]
    assert tuple(temporal.returns_to_old_state(states, ["k"], "t", [], "s").first()) == (2, 1, 50.0)


def test_reach_of_dense_keys(spark, tmp_path):
    """300 tables with ten keys each have more simple ways than could ever be listed."""
    tables, keys = 300, 10
    pairs = {(i, (i * 7 + j * j * 31 + 1) % tables) for i in range(tables) for j in range(keys)}
    edges = spark.createDataFrame(
        [(f"fk{i}_{j}", "s", f"t{i}", f"c{j}", "s", f"t{j}", "id") for i, j in sorted(pairs)],
        "constraint_name string, from_schema string, from_table string, from_column string, "
        "to_schema string, to_table string, to_column string",
    )
    columns = spark.createDataFrame(
        [("s", f"t{i}", f"c{j}", (i + j) % 3 > 0) for i, j in sorted(pairs)],
        "schema_name string, table_name string, column_name string, nullable boolean",
    )

    def fewest(links):
        following = {a: {d for c, d in links if c == a} for a in range(tables)}
        found = {}
        for start in range(tables):
            level, n, seen = following[start], 1, set()
            while level:
                found |= {(start, b): n for b in level}
                seen |= level
                level, n = {d for b in level for d in following[b]} - seen, n + 1
        return found

    mandatory = {(a, b) for a, b in pairs if (a + b) % 3 == 0}
    every, needed = fewest(pairs), fewest(mandatory)
    reach = integrity.foreign_key_reach(edges, columns, str(tmp_path / "reach"))
    found = {(r.from_table, r.to_table): (r.links, r.mandatory_links) for r in reach.collect()}
    assert found == {(f"s.t{a}", f"s.t{b}"): (n, needed.get((a, b))) for (a, b), n in every.items()}
    both = {(a, b) for a, b in every if (b, a) in every}
    cycles = {r.table_name: (r.cycle, r.tables) for r in integrity.foreign_key_cycles(reach).collect()}
    assert cycles == {
        f"s.t{a}": (min(f"s.t{d}" for c, d in both if c == a), sum(c == a for c, _ in both))
        for a in {a for a, _ in both}
    }


def test_chains_of_a_chosen_start(spark, tmp_path, rows):
    edges = spark.createDataFrame(
        [("k1", "s", "a", "x", "s", "b", "id"), ("k2", "s", "b", "y", "s", "c", "id"),
         ("k3", "s", "c", "z", "s", "a", "id")],
        "constraint_name string, from_schema string, from_table string, from_column string, "
        "to_schema string, to_table string, to_column string",
    )
    columns = spark.createDataFrame(
        [("s", "a", "x", False)], "schema_name string, table_name string, column_name string, nullable boolean"
    )
    found = integrity.foreign_key_chains(edges, columns, str(tmp_path / "b"), start="s.b")
    assert rows(found) == [("s.b -> s.c -> s.a", 2, False), ("s.b -> s.c", 1, False)]
    empty = integrity.foreign_key_reach(edges.limit(0), columns, str(tmp_path / "none"))
    assert empty.count() == 0
    assert integrity.foreign_key_cycles(empty).count() == 0


def test_latency_reads_its_rows_once(spark, tmp_path):
    """Each pass of the percentiles and the summary once read the table, and a view's join, again."""
    rows = [(datetime(2024, 1, 1), datetime(2024, 1, 1) + timedelta(seconds=x)) for x in [*range(100), 10**7, -5]]
    frame = spark.createDataFrame([*rows, *rows[:3], (None, rows[0][1]), (rows[0][0], None)], "a timestamp_ntz, b timestamp_ntz")
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    found = timeliness.entry_latency(frame.mapInArrow(counted, frame.schema), "a", "b").collect()
    assert seen.value == len(rows) + 5
    seconds = sorted([*range(100), 10**7, -5, 0, 1, 2])
    assert tuple(found[0]) == (105, round(sum(seconds) / 105, 3), seconds[52], 10**7, 1, 1)
    none = timeliness.entry_latency(frame.limit(0), "a", "b").collect()
    assert [tuple(r) for r in none] == [(0, None, None, None, 0, 0)]
    times = spark.createDataFrame([(5, 3), (9, 1), (None, 7)], "v long, times long")
    shares = {"low": 0.75, "high": 0.76}
    assert dict(map(tuple, timeliness.exact_percentiles(times, F.col("v"), shares, F.col("times")).collect())) == {"low": 5, "high": 9}
