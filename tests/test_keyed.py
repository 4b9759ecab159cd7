"""The skew-safe building blocks against brute force, with hot and NULL keys."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from dqloom.operators import keyed


def skewed_key(rng):
    """A third of the rows share one key, some keys are NULL."""
    draw = rng.random()
    return 7 if draw < 0.34 else None if draw < 0.45 else rng.randint(0, 40)


def test_union_all_keeps_every_frame(spark):
    frames = [spark.createDataFrame([(i,)], "i int") for i in range(7)]
    assert sorted(r.i for r in keyed.union_all(frames).collect()) == list(range(7))
    with pytest.raises(ValueError):
        keyed.union_all([])


def test_key_presence(spark, rows):
    child = spark.createDataFrame(
        [(1, "a"), (1, "a"), (1, None), (2, "b"), (None, None)], "x int, y string"
    )
    parent = spark.createDataFrame([(1, "a"), (1, "a"), (3, "c"), (None, "b")], "p long, q string")
    found = keyed.key_presence(child, parent, [("x", "p"), ("y", "q")])
    assert rows(found) == sorted([(1, "a", 2, True), (2, "b", 1, False), (3, "c", 0, True)], key=repr)


def test_hot_keys_are_found(spark):
    rng = random.Random(3)
    frame = spark.createDataFrame([(skewed_key(rng),) for _ in range(3000)], "k int")
    hot = keyed.frequent_hashes(frame.filter("k IS NOT NULL"), ["k"])
    seven = frame.filter("k = 7").select(keyed.key_hash(frame, ["k"]).alias("h")).first().h
    assert hot[seven] > 1
    uniform = spark.range(5000).withColumnRenamed("id", "k")
    assert keyed.frequent_hashes(uniform, ["k"]) == {}
    assert keyed.frequent_hashes(uniform.limit(0), ["k"]) == {}


@pytest.mark.parametrize("right_type", ["int", "long", "decimal(10,0)"])
def test_spread_left_join_equals_plain_join(spark, rows, right_type):
    rng = random.Random(5)
    left = spark.createDataFrame(
        [(skewed_key(rng), i % 5) for i in range(2000)], "k int, v int"
    )
    right = spark.createDataFrame([(k, f"r{k}") for k in range(0, 30)], "k int, name string")
    right = right.withColumn("k", F.col("k").cast(right_type))
    found = keyed.spread_left_join(left, right, ["k"]).select(F.col("k").cast("int"), "v", "name")
    plain = left.join(right, "k", "left").select("k", "v", "name")
    assert rows(found) == rows(plain)


def test_spread_left_join_uses_many_tasks_for_a_hot_key(spark):
    left = spark.range(4000).select(F.lit(1).alias("k"), "id")
    right = spark.createDataFrame([(1, "one")], "k int, name string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = keyed.spread_left_join(left, right, ["k"])
        assert joined.filter("name = 'one'").count() == 4000
        tasks = joined.select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan and tasks >= 1


def test_equal_rows_of_a_hot_key_are_dealt_evenly(spark):
    """Two fifths of all rows are one row, read by four map tasks."""
    rows, partitions = 100_000, 500
    hot = F.col("id") % 5 < 2
    left = spark.range(0, rows, 1, 4).select(
        F.when(hot, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.when(hot, F.lit(0.5)).otherwise(0.0).alias("v")
    )
    right = spark.createDataFrame([(-1, "one"), (4, "four")], "k bigint, name string")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
                "spark.sql.shuffle.partitions": str(partitions)}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        joined = keyed.spread_left_join(left, right, ["k"])
        tasks = joined.groupBy(F.spark_partition_id().alias("p")).agg(
            F.count(F.lit(1)).alias("n"), F.count_if(F.col("name") == "one").alias("hot")
        ).collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sum(t.n for t in tasks) == rows and sum(t.hot for t in tasks) == rows * 2 // 5
    assert max(t.n for t in tasks) < 2 * rows / partitions


def test_equal_rows_come_back_as_they_were(spark, rows):
    zero, unknown = float("-0.0"), float("nan")
    values = [(1, zero, "a", b"x"), (1, 0.0, "a", b"x"), (1, unknown, None, None), (1, None, "b", b"")]
    frame = spark.createDataFrame(
        [*values * 40, *[(k, 1.0, "c", None) for k in range(2, 30)], (None, 2.0, None, None)],
        "k int, v double, `t.x` string, b binary",
    )
    right = spark.createDataFrame([(1, "one"), (5, "five")], "k int, name string")
    found = keyed.spread_left_join(frame, right, ["k"])
    plain = frame.join(right, "k", "left").select("k", "v", "`t.x`", "b", "name")
    assert found.columns == plain.columns
    assert list(map(repr, rows(found))) == list(map(repr, rows(plain)))  # NaN is not equal to itself


def test_zero_signs_are_one_key(spark):
    left = spark.createDataFrame([(-0.0, i) for i in range(50)], "k double, i int")
    right = spark.createDataFrame([(0.0, "zero")], "k double, name string")
    assert keyed.spread_left_join(left, right, ["k"]).filter("name = 'zero'").count() == 50


@pytest.mark.parametrize("keep_nulls", [True, False])
def test_pair_agreement_counts_pairs_of_duplicates(spark, keep_nulls):
    rng = random.Random(8)
    left = [(skewed_key(rng), rng.choice(["a", "b", None])) for _ in range(300)]
    right = [(skewed_key(rng), rng.choice(["a", "b", None])) for _ in range(200)]
    pairs = [
        (v, w) for k, v in left for j, w in right
        if k is not None and k == j and (keep_nulls or (v is not None and w is not None))
    ]
    found = keyed.pair_agreement(
        spark.createDataFrame(left, "k int, v string"),
        spark.createDataFrame(right, "j long, w string"),
        [("k", "j")], ("v", "w"), keep_nulls,
    ).first()
    assert found.checked_count == len(pairs)
    assert found.agreeing_count == sum(v == w for v, w in pairs)


def history(seed, size=400):
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    return [
        (skewed_key(rng), start + timedelta(hours=rng.randint(0, 200)), i, rng.choice("abc"),
         rng.randint(0, 99))
        for i in range(size)
    ]


HISTORY = "k int, t timestamp_ntz, i int, s string, n int"


def wanted_history(data):
    wanted, groups = {}, defaultdict(list)
    for row in data:
        groups[row[0]].append(row)
    for group in groups.values():
        group.sort(key=lambda r: (r[1], r[2]))
        for j, row in enumerate(group):
            before = group[:j]
            wanted[row[2]] = (before[-1][3] if before else None, j + 1, max((r[4] for r in before), default=None))
    return wanted


@pytest.mark.parametrize("segment", [1, 7, 40, 10_000])
def test_previous_version_and_running_max(spark, monkeypatch, segment):
    monkeypatch.setattr(keyed, "LEAST_SEGMENT", segment)
    data = history(segment)
    # two entities with all rows at one time, and the NULL entity
    data += [(k, datetime(2024, 1, 1), 1000 + i * 3 + j, "abc"[i % 3], i % 50) for j, k in enumerate((77, None)) for i in range(150)]
    wanted = wanted_history(data)
    frame = spark.createDataFrame(data, HISTORY).withColumnRenamed("s", "s.`t")
    found = keyed.scanned(frame, ["k"], ["t", "i"], ["s.`t", "n"], True, "n")
    assert found.columns == [*frame.columns, "prev_s.`t", "prev_n", "version", "max_before"]
    assert {r["i"]: (r["prev_s.`t"], r["version"], r["max_before"]) for r in found.collect()} == wanted
    assert keyed.scanned(frame.limit(0), ["k"], ["t"], ["n"], True).count() == 0


def test_a_large_history_is_cut(spark, monkeypatch):
    """All rows at one time, of one entity and of the NULL entity: no segment has twice the average."""
    monkeypatch.setattr(keyed, "LEAST_SEGMENT", 100)
    at = datetime(2024, 1, 1)
    frame = spark.range(8000).select(
        F.when(F.col("id") < 5000, 1).alias("k"), F.lit(at).cast("timestamp_ntz").alias("t"), F.col("id").alias("i")
    )
    points = keyed.split_points(frame, ["k"], ["t", "i"]).collect()
    assert {r.e0 for r in points} == {1, None}
    for row, whole in ((r, 5000 if r.e0 else 3000) for r in points):
        cuts = [p.o1 - (0 if row.e0 else 5000) for p in row.points]
        sizes = [b - a for a, b in zip([0, *cuts], [*cuts, whole])]
        assert max(sizes) <= 2 * 8000 // 16
    plan = keyed.scanned(frame, ["k"], ["t", "i"], ["i"])._jdf.queryExecution().optimizedPlan().toString()
    # one window over rows, one over the segments of large entities
    assert plan.count("Window [") == 2 and "hint" not in plan


def test_group_sizes_leave_out_incomplete_keys(spark):
    frame = spark.createDataFrame(
        [("x" * 100, 1), ("x" * 100, 1), ("x" * 101, 1), (None, 1), ("y", None)], "t string, n int"
    )
    sizes = Counter(r.record_count for r in keyed.group_sizes(frame, ["t", "n"]).collect())
    assert sizes == {2: 1, 1: 1}


def test_many_text_columns_group_like_their_columns(spark):
    rng = random.Random(11)
    words = ["", "1:", ":", "a", "a1:", "2:ab", "é", "x" * 90]
    data = [
        (*[rng.choice(words) for _ in range(5)], rng.choice([1, 11, None]),
         rng.choice([0.0, -0.0, 1.5]), datetime(2024, 1, rng.randint(1, 2)))
        for _ in range(3000)
    ]
    # strung together without lengths, these two would be one key
    data += [("a", "1:", "", "", "", 1, 0.0, datetime(2024, 1, 1)),
             ("a1:", "", "", "", "", 1, 0.0, datetime(2024, 1, 1))] * 2
    frame = spark.createDataFrame(
        data, "a string, b string, c string, d string, e string, n int, x double, t timestamp"
    )
    assert len(keyed.grouping_keys(frame, frame.columns)) == 4
    wanted = Counter(row for row in data if None not in row)
    found = keyed.group_sizes(frame, frame.columns).collect()
    assert sorted(r.record_count for r in found) == sorted(wanted.values())


def test_nested_columns_can_be_keys(spark):
    frame = spark.createDataFrame([([1], 1), ([1], 1), ([2], 1)], "a array<int>, b int")
    sizes = keyed.group_sizes(frame, ["a", "b"]).collect()
    assert sorted(r.record_count for r in sizes) == [1, 2]


def test_spread_join_leaves_callers_names_alone(spark, rows):
    frame = spark.createDataFrame([(1, i % 2, i % 3) for i in range(200)], "k int, _n int, _place int")
    right = spark.createDataFrame([(1, "one")], "k int, _all string")
    assert rows(keyed.spread_left_join(frame, right, ["k"])) == rows(frame.join(right, "k", "left"))


def test_both_null_policies_share_one_shuffle(spark):
    left = spark.createDataFrame([(1, "a"), (1, None), (2, None), (None, "a"), (3, "b"), (3, "b")], "k int, v string")
    right = spark.createDataFrame([(1, "a"), (1, "c"), (2, None), (3, None), (3, "b"), (4, "x")], "k int, w string")
    both = keyed.union_all([
        keyed.pair_agreement(left, right, [("k", "k")], ("v", "w"), keep_nulls=keep) for keep in (True, False)
    ])
    # 1: 2 x 2 pairs, 2: 1, 3: 2 x 2; without NULLs 1 x 2, none, 2 x 1
    assert sorted(map(tuple, both.collect())) == [(4, 3), (9, 4)]
    assert "ReusedExchange" in both._jdf.queryExecution().executedPlan().toString()
