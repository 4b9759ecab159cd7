"""Inventories, profiles, growth, snapshots, registry and reports."""

from __future__ import annotations

import re
from collections import Counter

from collections import Counter
from datetime import date, datetime

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from dqloom.operators import growth, inventory, profile
from dqloom.plans import jobs, report
from dqloom.operators.keyed import union_all
from dqloom.sources import ranges, refresh, snapshots
from dqloom.sources.registry import TableRegistry, jdbc_options, user_schemas


@pytest.fixture
def mixed(spark):
    return spark.createDataFrame(
        [(1, "a", 1.5, datetime(2024, 1, 1), [1.0], {"k": 1}, date(2024, 1, 1), None),
         (2, "a", 1.5, datetime(2024, 1, 2), [1.0], {"k": 1}, None, None),
         (2, None, -0.0, datetime(2024, 1, 2), None, None, None, None),
         (9, "x" * 200, 0.0, None, [2.0], {"k": 2}, None, None),
         (9, "x" * 200, None, None, [2.0], {"j": 1}, None, None)],
        "i int, s string, d double, t timestamp_ntz, a array<float>, m map<string,int>, "
        "day date, never int",
    )


def test_value_counts(spark, mixed):
    found = {r.column_name: r for r in profile.value_counts(mixed, "s", "t").collect()}
    assert {c: (r.total_rows, r.null_count, r.distinct_count) for c, r in found.items()} == {
        "i": (5, 0, 3), "s": (5, 1, 2), "d": (5, 1, 2), "t": (5, 2, 2), "a": (5, 1, 2),
        "m": (5, 1, 3), "day": (5, 4, 1), "never": (5, 5, 0),
    }
    assert found["s"].null_pct == 20.0 and found["never"].null_pct == 100.0


def test_profiles_of_an_empty_table(spark, mixed):
    empty = mixed.limit(0)
    counts = profile.value_counts(empty, "s", "t").collect()
    assert len(counts) == 8
    assert {(r.total_rows, r.null_count, r.null_pct, r.distinct_count) for r in counts} == {
        (0, 0, None, 0)
    }
    shares = profile.null_share(empty, "s", "t").collect()
    assert {(r.total_rows, r.null_pct) for r in shares} == {(0, None)}
    assert profile.column_profile(empty, "s", "t").count() == 0


def test_bounds_and_top_values(spark, mixed):
    bounds = {r.column_name: (r.col_min, r.col_max)
              for r in profile.column_counts(mixed, "s", "t").collect()}
    assert bounds["i"] == ("1", "9") and bounds["a"] == (None, None)
    assert bounds["t"] == ("2024-01-01 00:00:00", "2024-01-02 00:00:00")
    top = profile.top_values(mixed, "s", "t", top=2).collect()
    found = {(r.column_name, r.rank): (r.value, r.n) for r in top}
    assert found[("i", 1)] == ("2", 2) and found[("i", 2)] == ("9", 2)
    assert found[("s", 2)] == ("x" * 200, 2)
    assert not any(r.column_name in ("a", "m", "never") for r in top)


def test_column_profile(spark, mixed):
    found = {r.column_name: r for r in profile.column_profile(mixed, "s", "t").collect()}
    assert found["i"].sample == "2 | 9" and found["i"].most_common_freqs == "40.0% | 40.0%"
    assert found["i"].distinct_pct == "60.0%"
    assert found["day"].sample == "2024-01-01" and found["day"].most_common_freqs == ""
    assert found["never"].sample == "" and found["never"].null_pct == 100.0
    masked = profile.column_profile(mixed, "s", "t", ["s"], extra_pii=["s.t.s"]).first()
    assert masked.sample == "*** | xx***" and masked.pii_phi


def test_approximate_profile(spark, mixed):
    found = {r.column_name: r for r in profile.approximate_profile(mixed, "s", "t").collect()}
    assert {c: (r.total_rows, r.null_count, r.cardinality) for c, r in found.items()} == {
        "i": (5, 0, 3), "s": (5, 1, 2), "d": (5, 1, 2), "t": (5, 2, 2), "a": (5, 1, 2),
        "m": (5, 1, 3), "day": (5, 4, 1), "never": (5, 5, 0),
    }
    assert sorted(found["i"].sample.split(" | ")) == ["2", "9"]
    assert found["i"].most_common_freqs == "40.0% | 40.0%" and found["i"].col_max == "9"
    assert found["day"].sample == "2024-01-01" and found["never"].sample == ""
    exact = profile.column_profile(mixed, "s", "t")
    assert exact.columns == profile.approximate_profile(mixed, "s", "t").columns


def test_wide_tables_are_read_in_batches(spark, monkeypatch):
    monkeypatch.setattr(profile, "COLUMNS_PER_AGGREGATE", 3)
    wide = spark.range(4).select(*[(F.col("id") % (i + 1)).alias(f"c{i}") for i in range(8)])
    assert profile.column_counts(wide, "s", "t").count() == 8
    assert Counter(r.total_rows for r in profile.null_share(wide, "s", "t").collect()) == {4: 8}


def test_registry(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/p")
    spark.range(2).write.json(f"{tmp_path}/j")
    spark.sql("CREATE DATABASE IF NOT EXISTS reg")
    spark.range(5).write.mode("overwrite").saveAsTable("reg.t")
    found = (
        TableRegistry(spark)
        .add_files("files", {"p": f"{tmp_path}/p"})
        .add_files("files", {"j": f"{tmp_path}/j"}, "json")
        .add_catalog("reg")
        .add("pg_temp_1", "gone", spark.range(1))
    )
    assert found.keys() == [("files", "j"), ("files", "p"), ("reg", "t")]
    counts = {r.table_name: r.row_count for r in inventory.row_counts(found).collect()}
    assert counts == {"j": 2, "p": 3, "t": 5}
    sizes = {r.table_name: r.total_bytes for r in inventory.file_sizes(found).collect()}
    on_disk = sum(f.stat().st_size for f in (tmp_path / "p").glob("part-*"))
    assert sizes["p"] == on_disk and sizes["t"] > 0
    assert found.by_reference("reg.t.id").count() == 5
    with pytest.raises(ValueError):
        found.table("reg", "absent")
    with pytest.raises(ValueError):
        found.by_reference("reg")
    spark.sql("DROP TABLE reg.t")


def test_schema_names(spark):
    names = ["b", "a", "pg_catalog", "information_schema", "pg_toast", "pg_temp_9", "pgxtemp"]
    tables = spark.createDataFrame([(n, "t") for n in names], "schema_name string, table_name string")
    assert [r[0] for r in user_schemas(tables).collect()] == ["a", "b", "pgxtemp"]


def test_jdbc_options_split_large_tables():
    options = jdbc_options("s", "t", "jdbc:x", ("id", 0, 100, 8), {"user": "u"})
    assert options["dbtable"] == '"s"."t"' and options["numPartitions"] == "8"
    assert "partitionColumn" not in jdbc_options("s", "t", "jdbc:x", None, {})


def test_column_types_and_comments(spark):
    frame = spark.sql("SELECT CAST(1 AS DECIMAL(8,2)) AS d, 'x' AS s").withMetadata(
        "s", {"comment": "a text"}
    )
    found = inventory.column_inventory(TableRegistry(spark).add("s", "t", frame)).collect()
    assert [(r.column_name, r.data_type, r.full_type, r.position, r.comment) for r in found] == [
        ("d", "decimal", "decimal(8,2)", 1, ""), ("s", "string", "string", 2, "a text"),
    ]


def test_composite_edges_pair_by_position(spark, rows):
    constraints = inventory.constraints_frame(spark, [
        *inventory.key_rows("pk", inventory.PRIMARY_KEY, "s", "p", ["x", "y"]),
        *inventory.key_rows("fk", inventory.FOREIGN_KEY, "s", "c", ["a", "b"], ("s", "pk")),
    ])
    edges = inventory.foreign_key_edges(constraints)
    assert [(e.from_column, e.to_column) for e in edges.collect()] == [("a", "x"), ("b", "y")]
    assert inventory.foreign_key_edges(constraints, "other").count() == 0
    tiers = spark.createDataFrame([("s", "p", "1"), ("s", "c", "2")],
                                  "schema_name string, table_name string, tier string")
    assert inventory.tier_one_edges(edges, tiers).count() == 0
    assert inventory.tier_one_edges(edges, tiers.withColumn("tier", F.lit("1"))).count() == 2


def test_no_matching_table_stops(spark):
    tables = spark.createDataFrame([("s", "t")], "schema_name string, table_name string")
    assert inventory.parse_table_tokens(' "A", , \'s.B\' ') == ["a", "s.b"]
    assert inventory.matching_tables(tables, []).count() == 1
    with pytest.raises(ValueError):
        inventory.require_match({"tables": tables.limit(0)}, ["x"])


def growth_of(spark, frame, **window):
    return tuple(growth.growth_rate(frame, "s", "t", **window).first())[2:]


def test_growth(spark):
    def frame(*days):
        return spark.createDataFrame([(d,) for d in days], "created_at timestamp_ntz")

    first, later = datetime(2024, 1, 1), datetime(2024, 3, 1)
    assert growth_of(spark, frame(first, later, later)) == (
        2, "MIN_TO_MAX(created_at)", "created_at, start_date: 2024-01-01 00:00:00",
    )  # 3 rows in exactly 60 days: 1.5 per month goes to the even number
    assert growth_of(spark, frame(first))[:2] == (None, "MIN_EQUALS_MAX(created_at)")
    assert growth_of(spark, frame(first, datetime(2024, 1, 2)))[:2] == (None, "SPAN_TOO_SHORT")
    assert growth_of(spark, frame(None))[:2] == (None, "ALL_NULL(created_at)")
    assert growth_of(spark, frame(first).limit(0)) == (None, "EMPTY_TABLE", "")
    inside = growth_of(spark, frame(first, later, later), start="2024-03-01", end="2024-03-01")
    assert inside[:2] == (2, "WINDOW(created_at)")
    wrong = growth_of(spark, frame(first, later, later), start="2024-03-01", end="2024-01-01")
    assert wrong[1] == "MIN_TO_MAX(created_at)"
    assert growth_of(spark, spark.range(2))[1] == "NO_TIMESTAMP"


def test_best_timestamp_column_prefers_the_first_on_a_tie(spark):
    at = datetime(2024, 1, 1)
    frame = spark.createDataFrame([(at, at, None)], "b_time timestamp_ntz, a_time timestamp_ntz, z_date timestamp_ntz")
    assert growth.timestamp_columns(frame) == ["a_time", "b_time", "z_date"]
    found = growth.best_timestamp_column(frame, "s", "t", ["z_date", "b_time", "a_time"]).first()
    assert (found.best_column, found.value_count) == ("b_time", 1)


def test_freshness(spark):
    at = datetime(2024, 1, 1)
    statistics = spark.createDataFrame(
        [("s", "both", at, datetime(2024, 1, 3)), ("s", "auto", None, at), ("s", "never", None, None)],
        "schema_name string, table_name string, last_manual timestamp_ntz, last_auto timestamp_ntz",
    )
    now = F.lit("2024-01-06 00:00:00").cast("timestamp_ntz")
    found = {r.table_name: (r.age_days, r.needs_analyze)
             for r in snapshots.freshness(statistics, now).collect()}
    assert found == {"both": (3.0, False), "auto": (5.0, False), "never": (None, True)}
    assert snapshots.freshness(statistics, now, 4).filter("needs_analyze").count() == 2
    with pytest.raises(ValueError):
        snapshots.freshness(statistics, now, -1)


def test_snapshot_is_kept_until_refreshed(spark, tmp_path):
    path = f"{tmp_path}/snap"
    first = snapshots.load_snapshot(spark, path, lambda: spark.range(3))
    assert first.count() == 3
    assert snapshots.load_snapshot(spark, path, lambda: spark.range(9)).count() == 3
    assert snapshots.load_snapshot(spark, path, lambda: spark.range(9), refresh=True).count() == 9


def test_shared_folder_is_the_cluster_setting(spark):
    assert snapshots.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_reconcile(spark, rows):
    ddl = "k string, n int, c string"
    old = spark.createDataFrame([("same", 1, None), ("changed", 1, "x"), ("absent", 1, "x")], ddl)
    new = spark.createDataFrame([("same", 1, None), ("changed", 1, None), ("new", 2, "y")], ddl)
    assert rows(snapshots.reconcile(old, new, ["k"])) == [
        ("absent", 1, "x", "ABSENT"), ("changed", 1, None, "CHANGED"), ("new", 2, "y", "NEW"),
        ("same", 1, None, "SAME"),
    ]


def test_results_of_other_steps_stay(spark, tmp_path):
    def result(step, check_id):
        return spark.createDataFrame(
            [("uniqueness", step, check_id, "k", "s", "t", "c", 1, 0, 0.0, "PASS", "")],
            report.RESULT_SCHEMA,
        )

    path = f"{tmp_path}/results"
    report.write_results(result(2, "a").union(result(4, "b")), path)
    report.write_results(result(4, "c"), path)
    assert {r.check_id for r in spark.read.parquet(path).collect()} == {"a", "c"}


def test_results_are_worked_out_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(x):
        seen.add(1)
        return x

    rows = [("uniqueness", 2, f"c{i}", "k", "s", "t", "c", 1, 0, 0.0, "PASS", "") for i in range(6)]
    results = spark.createDataFrame(rows, report.RESULT_SCHEMA).withColumn("check_id", counted("check_id"))
    path = f"{tmp_path}/results"
    old = spark.createDataFrame([("uniqueness", 4, "old", *rows[0][3:])], report.RESULT_SCHEMA)
    report.write_results(old, path)
    report.write_results(results, path, steps=[("uniqueness", 2), ("uniqueness", 4)])
    assert seen.value == 6
    assert {r.step for r in spark.read.parquet(path).collect()} == {2}


def test_metadata_job_saves_and_reuses(spark, tmp_path):
    registry = TableRegistry(spark).add("s", "t", spark.range(4))
    constraints = inventory.constraints_frame(
        spark, inventory.key_rows("pk", inventory.PRIMARY_KEY, "s", "t", ["id"])
    )
    known = spark.createDataFrame([("old", 1, 0)], "schema_name string, table_count long, total_bytes long")
    found = jobs.metadata_job(registry, constraints, str(tmp_path), known)
    column = found["columns"].first()
    assert (column.column_name, column.pk, column.distinct_count) == ("id", True, 4)
    assert {(r.schema_name, r.change) for r in found["schemas"].collect()} == {
        ("old", "ABSENT"), ("s", "NEW"),
    }
    registry.add("s", "t", spark.range(9))
    assert jobs.metadata_job(registry, constraints, str(tmp_path))["columns"].first().total_rows == 4


def test_long_common_values_are_found(spark):
    long = "x" * 2000
    frame = spark.createDataFrame([(long,)] * 5 + [("y",)] * 2, "v string")
    row = profile.approximate_profile(frame, "s", "t").first()
    assert row.most_common_freqs == "71.4% | 28.6%"
    assert row.sample == "x" * 500 + " | y"


def test_variant_and_odd_names(spark):
    frame = spark.sql("""SELECT parse_json('{"a": 1}') AS v, 1 AS `a.b`, 'q' AS `c``d`
                         UNION ALL SELECT NULL, 2, 'q' UNION ALL SELECT parse_json('{"a":1}'), 2, NULL""")
    exact = {r.column_name: (r.total_rows, r.null_count, r.distinct_count)
             for r in profile.value_counts(frame, "s", "t").collect()}
    assert exact == {"v": (3, 1, 1), "a.b": (3, 0, 2), "c`d": (3, 1, 1)}
    for report in (profile.approximate_profile, profile.column_profile):
        found = {r.column_name: (r.total_rows, r.null_count, r.cardinality)
                 for r in report(frame, "s", "t").collect()}
        assert found == exact


def test_bounds_show_no_negative_zero(spark):
    frame = spark.createDataFrame([(-0.0,), (0.0,)], "x double").repartition(1).sortWithinPartitions("x")
    for data in (frame, spark.createDataFrame([(-0.0,)], "x double")):
        row = profile.column_counts(data, "s", "t").first()
        assert (row.col_min, row.col_max) == ("0.0", "0.0")


@pytest.mark.parametrize("name", ["column_profile", "approx_profile", "column_min_max"])
def test_profiles_read_all_tables(spark, name):
    from verification import metadata  # noqa: F401
    from verification.fixtures import ALL_TABLES, QUERIES, Lab

    lab = Lab(spark, "/root/testdata/sf0.001")
    found = {tuple(r) for r in QUERIES[name](lab).select("schema_name", "table_name", "column_name").collect()}
    columns = {(s, t, c) for s, t in ALL_TABLES for c in lab.registry.table(s, t).columns}
    empty = {c for c in columns if c[1] == "account_archive"}
    assert columns - empty <= found <= columns


def test_common_long_texts_are_looked_up(spark):
    """Equal beginnings, equal counts, lengths around the limit of a key, several text columns."""
    begin = "x" * profile.PREFIX
    values = [begin + tail for tail in ("d", "b", "c", "a", "", "b" * 5000, "a" * 70_000)] + ["w", "y", begin[:-1]]
    rows = [(v, v[::-1], i % 3) for v in values for i in range(3)] + [("z" * 900, None, None)] * 9 + [(None, None, 1)]
    frame = spark.createDataFrame(rows, "v string, w string, n int").repartition(4)
    counts = Counter(r[0] for r in rows if r[0] is not None)
    wanted = sorted(counts.items(), key=lambda item: (-item[1], item[0]))[:4]
    top = profile.top_values(frame, "s", "t", top=4)
    found = {(r.column_name, r["rank"]): (r.value, r.n) for r in top.collect()}
    assert [found["v", i] for i in range(1, 5)] == wanted
    backward = Counter(r[1] for r in rows if r[1] is not None)
    assert [found["w", i] for i in range(1, 5)] == sorted(backward.items(), key=lambda item: (-item[1], item[0]))[:4]
    assert [found["n", i] for i in range(1, 4)] == [("1", 11), ("0", 10), ("2", 10)]
    report_row = profile.column_profile(frame, "s", "t", ["v"], top=2).first()
    assert (report_row.cardinality, report_row.null_count, report_row.col_min, report_row.col_max) == (11, 1, "w", "z" * 900)
    assert report_row["sample"].startswith("z" * 900) and report_row["sample"].endswith("w")


def test_no_shuffle_carries_a_text(spark, tmp_path):
    spark.range(2000).select(F.concat(F.repeat(F.sha2(F.col("id").cast("string"), 256), 200)).alias("v")).write.parquet(f"{tmp_path}/t")
    frame = spark.read.parquet(f"{tmp_path}/t")  # 12,800 characters a text, each once
    values, slots = profile.histogram(frame, ["v"], late=True)
    longest = values.select(F.max(F.length("v0"))).first()[0]
    assert longest == profile.PREFIX + 65
    found = profile.column_profile(frame, "s", "t")
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # histogram, bounds, late lookup
    assert "sha2" in plan and len(re.findall(r"FileScan parquet", plan)) <= 3


def test_refresh_reads_only_new_files(spark, tmp_path, rows):
    path, state = str(tmp_path / "table a"), str(tmp_path / "state")
    columns = "k int, `a.b` double, t string, d decimal(10,2), m map<string,int>, l array<int>"

    def deliver(values):
        spark.createDataFrame(
            [(k, v, t, None if k is None else Decimal(k) / 4, {"x": 1}, [k]) for k, v, t in values], columns
        ).coalesce(1).write.mode("append").parquet(path)

    def run(where=state):
        return refresh.refresh_profile(spark, path, where, "s", "t")

    spark.createDataFrame([], columns).coalesce(1).write.parquet(path)
    assert {r.total_rows for r in run().profile.collect()} == {0}
    deliver([(1, -0.0, "b"), (None, 2.5, "b"), (7, None, "x" * 3000)])
    run()
    deliver([(9, 0.0, "a"), (9, float("nan"), None)])
    before = run(str(tmp_path / "other")).profile
    found = run()
    assert found.added.agg({"rows": "sum"}).first()[0] == 2  # the first delivery is not read again
    assert found.added.count() == 1
    assert rows(found.profile) == rows(before)
    by = {r.column_name: r for r in found.profile.collect()}
    assert (by["k"].total_rows, by["k"].null_count, by["k"].cardinality, by["k"].col_sum) == (5, 1, 3, "26")
    assert (by["k"].col_min, by["k"].col_max, by["k"].common_values) == ("1", "9", "9")
    assert (by["a.b"].null_count, by["a.b"].col_min, by["a.b"].col_max) == (1, "0.0", "NaN")
    assert (by["d"].col_sum, by["m"].cardinality, by["l"].col_min) == ("6.50", 0, None)
    assert by["t"].common_values == "b" and by["t"].col_max == "x" * 3000
    assert run().added.count() == 0


def test_refresh_reads_exactly_the_added_files(spark, tmp_path):
    path, state = str(tmp_path / "table"), str(tmp_path / "state")
    spark.range(10).repartition(3).write.parquet(path)
    refresh.refresh_profile(spark, path, state, "s", "t")
    old = set(spark.read.parquet(path).inputFiles())
    spark.range(10, 15).coalesce(1).write.mode("append").parquet(path)
    opened = []
    statistics = refresh.file_statistics

    def watched(frame):
        opened.extend(frame.inputFiles())
        return statistics(frame)

    refresh.file_statistics = watched
    try:
        found = refresh.refresh_profile(spark, path, state, "s", "t").profile.first()
    finally:
        refresh.file_statistics = statistics
    assert len(opened) == 1 and not old & set(opened)
    assert (found.total_rows, found.col_min, found.col_max, found.cardinality) == (15, "0", "14", 15)


def test_refresh_forgets_removed_files_and_starts_anew_for_new_columns(spark, tmp_path):
    path, state = str(tmp_path / "table"), str(tmp_path / "state")
    spark.range(4).coalesce(1).write.parquet(path)
    refresh.refresh_profile(spark, path, state, "s", "t")
    spark.range(100, 103).coalesce(1).write.mode("overwrite").parquet(path)
    found = refresh.refresh_profile(spark, path, state, "s", "t").profile.first()
    assert (found.total_rows, found.col_min) == (3, "100")
    spark.range(2).selectExpr("id", "id AS other").coalesce(1).write.mode("overwrite").parquet(path)
    found = refresh.refresh_profile(spark, path, state, "s", "t").profile.collect()
    assert {(r.column_name, r.total_rows) for r in found} == {("id", 2), ("other", 2)}


def test_ranges_are_even_for_uneven_keys(spark):
    keys = [*range(1000), 10**12, *[5000] * 300, None, None]
    frame = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "`the key` bigint, n int")
    conditions = ranges.planned_for(frame, "the key", 100)
    counts = [frame.filter(c).count() for c in conditions]
    assert sum(counts) == len(keys) and len(conditions) > 9
    assert sorted(counts)[-2] <= 150 and max(counts) <= 301 + 150  # one key alone has 300 rows
    assert ranges.planned_for(frame.filter("n < 0"), "the key", 100) == ["1 = 1"]
    assert ranges.planned_for(frame.filter("`the key` IS NULL"), "the key", 1) == ["1 = 1"]
    days = spark.range(50).selectExpr("date_add(DATE '2024-01-01', CAST(id AS INT)) AS d",
                                      "CAST(id AS DOUBLE) / 7 AS v", "timestampadd(SECOND, id, TIMESTAMP '2024-01-01') AS t")
    for column in ("d", "v", "t"):
        counts = [days.filter(c).count() for c in ranges.planned_for(days, column, 10)]
        assert sum(counts) == 50 and max(counts) <= 15
    with pytest.raises(ValueError):
        ranges.planned_for(spark.createDataFrame([("a",)], "s string"), "s", 1)
    odd = spark.createDataFrame([(float("nan"),), (float("inf"),), (1.0,), (2.0,), (3.0,), (None,)], "x double")
    assert sum(odd.filter(c).count() for c in ranges.planned_for(odd, "x", 2)) == 6


def test_jdbc_tables_are_split_where_the_rows_are(spark):
    """The option builder's texts, run by Spark on a view that stands for the database's table."""
    keys = [*range(2000), 10**9, None]
    spark.createDataFrame([(k, "x") for k in keys], "id bigint, v string").createOrReplaceTempView("far_table")
    asked, read = [], []

    def text(name):
        return name.replace('"s"."far"', "far_table").replace('"', "`")

    def open_options(options):
        asked.append(options)
        return spark.sql(text(options["query"]) if "query" in options else f"SELECT * FROM {text(options['dbtable'])}")

    def open_ranges(options, conditions):
        read.extend(conditions)
        return union_all([spark.sql(f"SELECT * FROM far_table WHERE {text(c)}") for c in conditions])

    source = ranges.JdbcTable(spark, "s", "far", "jdbc:x", {"user": "u"}, open_options, open_ranges)
    assert source.load("id", 500).count() == len(keys)
    assert asked[0]["query"] == 'SELECT min("id") AS low, max("id") AS high, count(*) AS row_count FROM "s"."far"'
    assert asked[1]["dbtable"] == '(SELECT "id" FROM "s"."far") key_values'
    assert (asked[1]["lowerBound"], asked[1]["upperBound"], asked[1]["numPartitions"]) == ("0", "1000000000", "5")
    sizes = [spark.sql(f"SELECT * FROM far_table WHERE {text(c)}").count() for c in read]
    assert len(sizes) == 5 and max(sizes) <= 600
    assert source.load("id", 10_000).count() == len(keys) and "numPartitions" not in asked[-1]


def test_histogram_unpivots_rows(spark):
    """Values of all types, nested ones and NULLs, and names that hold braces, blanks and backticks."""
    frame = spark.sql("""SELECT 1 AS `a {b}`, 'q' AS `c``d`, array(1, NULL) AS l, map('k', 1) AS m, 2 AS n
                         UNION ALL SELECT 1, NULL, array(1, NULL), map('k', 1), NULL
                         UNION ALL SELECT NULL, 'r', NULL, NULL, 2""")
    values, slots = profile.histogram(frame, frame.columns)
    assert len(slots) == 4
    found = sorted((r.column_name, r.n, r.filled, r.sortable) for r in values.collect())
    assert found == [
        ("a {b}", 1, False, False), ("a {b}", 2, True, True), ("c`d", 1, False, False), ("c`d", 1, True, True),
        ("c`d", 1, True, True), ("l", 1, False, False), ("l", 2, True, False), ("m", 1, False, False),
        ("m", 2, True, False), ("n", 1, False, False), ("n", 2, True, True),
    ]
    plan = values._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" in plan and "Generate" not in plan


def test_sketches_hold_numbers_and_times_as_they_are(spark):
    frame = spark.sql("""SELECT id % 3 AS i, CAST(id % 2 AS DOUBLE) / 4 AS d, id % 2 = 0 AS b,
                         date_add(DATE '2020-01-01', CAST(id % 4 AS INT)) AS t, CAST(id % 5 AS DECIMAL(5, 2)) AS c
                         FROM range(40)""")
    found = profile.approximate_profile(frame, "s", "t")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    sketched = re.findall(r"approx_top_k\((\w+)", plan)
    assert sorted(s for s in sketched if s != "cast") == ["b", "d", "i", "t"]
    exact = {r.column_name: (r.sample, r.most_common_freqs) for r in profile.column_profile(frame, "s", "t").collect()}
    assert {r.column_name: (r.sample, r.most_common_freqs) for r in found.collect()} == exact
