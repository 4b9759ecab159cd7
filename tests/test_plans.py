"""What the plans look like: scans, shuffles, joins, columns read."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from dqloom.operators import completeness, consistency, growth, profile, uniqueness, validity
from dqloom.sources.registry import TableRegistry


@pytest.fixture(scope="module")
def registry(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("plans")
    spark.range(500).select(
        "id", (F.col("id") % 7).alias("fk"), F.concat(F.lit("n"), "id").alias("name"),
        (F.col("id") / 2).alias("amount"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("created_at"),
        F.lit("2024-02-01").cast("timestamp_ntz").alias("updated_at"),
    ).write.parquet(f"{folder}/t")
    spark.range(5).select("id", F.lit("p").alias("label")).write.parquet(f"{folder}/p")
    return TableRegistry(spark).add_files("s", {"t": f"{folder}/t", "p": f"{folder}/p"})


def executed(frame) -> str:
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


def read_schemas(plan: str) -> list[str]:
    return sorted(re.findall(r"ReadSchema: struct<([^>]*)>", plan))


def shuffles(plan: str) -> int:
    return len(re.findall(r"[-:+] Exchange hashpartitioning", plan))


def test_orphans_read_only_keys_and_join_nothing(registry):
    plan = executed(
        consistency.orphan_records(registry.table("s", "t"), registry.table("s", "p"), [("fk", "id")])
    )
    assert "Join" not in plan and shuffles(plan) == 1
    assert read_schemas(plan) == ["fk:bigint", "id:bigint"]
    assert "IsNotNull(fk)" in plan


def test_cross_table_check_joins_nothing(registry):
    table = registry.table("s", "t")
    plan = executed(
        consistency.cross_table_check(table, table, [("fk", "fk")], ("name", "name"))
    )
    assert "Join" not in plan and shuffles(plan) == 2


def test_rules_of_a_table_share_a_scan(registry):
    rule = dict(table="s.t", start_column="created_at", end_column="updated_at")
    plan = executed(consistency.date_order(registry, [dict(rule, id="a"), dict(rule, id="b")]))
    assert plan.count("FileScan") == 1 and shuffles(plan) == 0
    rules = [dict(id=str(i), column=f"s.t.{c}", allowed_values=["x"]) for i, c in enumerate(["name", "name"])]
    assert executed(consistency.enum_checks(registry, rules)).count("FileScan") == 1


@pytest.mark.parametrize("build", [
    lambda f: profile.column_counts(f, "s", "t"),
    lambda f: profile.null_share(f, "s", "t"),
    lambda f: profile.value_counts(f, "s", "t"),
    lambda f: profile.approximate_profile(f, "s", "t"),
    lambda f: profile.top_values(f, "s", "t"),
    lambda f: completeness.dirty_values(f, "s", "t"),
    lambda f: growth.growth_rate(f, "s", "t"),
    lambda f: validity.validity_checks(f, [validity.ValidityRule("r", "amount", "number_range", 0),
                                           validity.ValidityRule("q", "name", "email")]),
    lambda f: uniqueness.duplicates(f, "s", "t", ["fk", "name"]),
])
def test_row_local_work_is_one_scan(registry, build):
    assert executed(build(registry.table("s", "t"))).count("FileScan") == 1


def test_column_profile_reads_counts_and_bounds_apart(registry):
    """A histogram of keys and an aggregate for the bounds; texts are looked up only where long ones are common."""
    plan = executed(profile.column_profile(registry.table("s", "t"), "s", "t"))
    assert plan.count("FileScan") == 2


def test_common_values_are_limited_before_the_shuffle(registry):
    plan = executed(profile.top_values(registry.table("s", "t"), "s", "t"))
    assert "WindowGroupLimit" in plan


def test_duplicates_combine_before_the_shuffle(registry):
    plan = executed(uniqueness.duplicates(registry.table("s", "t"), "s", "t", ["fk"]))
    assert read_schemas(plan) == ["fk:bigint"] and shuffles(plan) == 1
    assert "partial_count" in plan and "IsNotNull(fk)" in plan


def declared(name, column, child="t", parent="p"):
    return [{"constraint_name": name, "from_schema": "s", "from_table": child, "from_column": column,
             "to_schema": "s", "to_table": parent, "to_column": "id", "column_position": 1}]


def test_foreign_keys_of_a_table_share_a_scan(registry):
    keys = [declared("a", "id"), declared("b", "fk"), declared("c", "id", parent="t")]
    found = consistency.orphan_checks(registry, keys)
    plan = executed(found)
    assert plan.count("FileScan") == 2  # child and parent
    assert shuffles(plan) == 2 and "partial_sum" in plan
    assert read_schemas(plan) == ["id:bigint", "id:bigint,fk:bigint"]
    rows = {r["constraint_name"]: (r["checked_count"], r["orphan_count"]) for r in found.collect()}
    assert rows == {"a": (500, 495), "b": (500, 500 - 358), "c": (500, 0)}


def test_unique_constraints_of_a_table_share_a_scan(registry):
    found = uniqueness.unique_checks(registry, [
        ("s", "t", "u1", ["id"]), ("s", "t", "u2", ["fk", "name"]), ("s", "t", "u3", ["fk"]),
    ])
    plan = executed(found)
    assert plan.count("FileScan") == 1 and shuffles(plan) == 2
    assert {r["constraint_name"]: r["duplicate_row_count"] for r in found.collect()} == {
        "u1": 0, "u2": 0, "u3": 500}
