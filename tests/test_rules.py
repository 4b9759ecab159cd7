"""Rule tables, candidates and gates."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from dqloom.operators import candidates, completeness, inventory, uniqueness
from dqloom.plans import jobs
from dqloom.sources import rules
from dqloom.sources.registry import TableRegistry

GOOD = dict(id="e", dimension="consistency", step="enum_check", status="confirmed",
            pattern="enum", column="s.t.c", allowed_values=["A"])


def errors(spark, *found):
    frame = rules.validation_errors(rules.rules_frame(spark, list(found)))
    return sorted(row.error for row in frame.collect())


def test_valid_rules_have_no_errors(spark):
    assert errors(
        spark, GOOD,
        dict(id="d", pattern="date_order", table="s.t", start_column="a", end_column="b"),
        dict(id="t", pattern="total_detail", total_table="s.t", total_column="a",
             detail_table="s.d", detail_column="b", join_columns=[dict(total="k", detail="k")]),
        dict(id="s", pattern="status_terminal", table="s.t", status_column="c",
             entity_columns=["e"], event_time_column="at", terminal_values=["x"],
             require_terminal=False),
        dict(id="c", pattern="duplicated_value", source="s.t.c", target="s.d.c",
             join=[dict(source="s.t.k", target="s.d.k")]),
    ) == []


@pytest.mark.parametrize("change, error", [
    (dict(id=None), "missing id"),
    (dict(pattern="regex"), "unsupported pattern"),
    (dict(pattern=None), "missing pattern"),
    (dict(column="t.c"), "expected schema.table.column: t.c"),
    (dict(column=None), "missing column"),
    (dict(allowed_values=[]), "missing allowed_values"),
    (dict(allowed_values=["A", None]), "NULL in allowed_values"),
])
def test_wrong_enum_rules(spark, change, error):
    assert errors(spark, {**GOOD, **change}) == [error]


def test_wrong_pattern_rules(spark):
    assert errors(spark, dict(id="d", pattern="date_order", table="t", operator="!=")) == [
        "expected schema.table: t", "missing end_column", "missing start_column",
        "unsupported operator",
    ]
    assert errors(
        spark,
        dict(id="s", pattern="status_terminal", table="s.t", status_column="c",
             entity_columns=[], event_time_column=None, terminal_values=None),
    ) == ["missing entity_columns", "missing event_time_column", "missing terminal_values",
          "require_terminal is not a boolean"]
    assert errors(
        spark,
        dict(id="t", pattern="total_detail", total_table="s.t", total_column="a",
             detail_table="s.d", detail_column="b", join_columns=[dict(total="k", detail="")]),
    ) == ["invalid join_columns"]
    assert errors(
        spark,
        dict(id="c", pattern="duplicated_value", source="s.t.c", target="s.d.c",
             join=[dict(source="s.t.k", target="k")], null_policy="never"),
    ) == ["invalid join reference", "unsupported null_policy"]


def test_planned_rules_are_confirmed_and_valid(spark):
    frame = rules.rules_frame(spark, [
        GOOD, {**GOOD, "id": "a"}, {**GOOD, "id": "p", "status": "need_check"},
        {**GOOD, "id": "w", "allowed_values": []},
    ])
    assert [rule["id"] for rule in rules.planned(frame)] == ["a", "e"]


def test_rules_from_json(spark, tmp_path):
    (tmp_path / "rules.json").write_text(json.dumps(GOOD) + "\n", encoding="utf-8")
    found = rules.read_rules(spark, str(tmp_path)).first()
    assert found.allowed_values == ["A"] and found.tolerance is None


def test_merge_keeps_existing_rules(spark, rows):
    known = rules.rules_frame(spark, [GOOD])
    fresh = rules.rules_frame(spark, [{**GOOD, "status": "need_check"}, {**GOOD, "id": "n"},
                                      {**GOOD, "id": "n"}])
    merged = rules.merge_new(known, fresh).select("id", "status")
    assert rows(merged) == [("e", "confirmed"), ("n", "confirmed")]


def test_readiness(spark):
    frame = rules.rules_frame(spark, [GOOD, {**GOOD, "id": "x", "status": None}])
    steps = spark.createDataFrame([("consistency", "enum_check"), ("consistency", "none")],
                                  "dimension string, step string")
    found = {r.step: tuple(r)[2:] for r in rules.readiness(frame, steps).collect()}
    assert found == {"enum_check": (2, 1, True, False), "none": (0, 0, False, True)}


def tier_frame(spark, *found):
    return spark.createDataFrame(
        [(f"r{i}", status, "data-owner", "s", table, tier)
         for i, (table, tier, status) in enumerate(found)], rules.TIER_SCHEMA,
    )


def test_tiers(spark):
    good = tier_frame(spark, ("a", "1", "confirmed"), ("a", "1", "confirmed"),
                      ("b", "2", "need_check"))
    assert [tuple(r) for r in rules.table_tiers(good).collect()] == [("s", "a", "1")]
    for bad in (tier_frame(spark, ("a", "1", "confirmed"), ("a", "2", "confirmed")),
                tier_frame(spark, ("a", None, "confirmed"))):
        with pytest.raises(ValueError):
            rules.table_tiers(bad)


def test_prepared_tiers(spark):
    tables = spark.createDataFrame(
        [("s", t) for t in ("a", "audit_x", "dm_y", "plain", "blog")],
        "schema_name string, table_name string",
    )
    known = tier_frame(spark, ("a", "2", "need_check"), ("dm_y", None, "need_check"),
                       ("plain", "x", "confirmed"))
    found = {r.table_name: (r.tier, r.status, r.owner)
             for r in candidates.prepare_tiers(tables, known).collect()}
    assert found == {
        "a": (2, "confirmed", "data-owner"), "audit_x": (3, "confirmed", "system"),
        "dm_y": (2, "confirmed", "system"), "plain": (None, "need_check", "data-owner"),
        "blog": (None, "need_check", "data-owner"),
    }
    open_tables = candidates.tables_without_tier(tables, candidates.prepare_tiers(tables, known))
    assert {r.table_name for r in open_tables.collect()} == {"plain", "blog"}


def test_null_rules(spark):
    columns = spark.createDataFrame(
        [("s", "t", c, w) for c, w in
         [("ngay_x", "CRITICAL"), ("other", "SUSPECT"), ("named", "CRITICAL"), ("fine", "OK")]],
        "schema_name string, table_name string, column_name string, null_warning string",
    )
    known = spark.createDataFrame(
        [("k", "need_check", "me", "s", "t", "named", " Valid NULL "),
         ("w", "confirmed", "me", "s", "t", "fine", "Sometimes")], rules.NULL_RULE_SCHEMA,
    )
    prepared = candidates.prepare_null_rules(columns, known)
    found = {r.column_name: (r.null_classify, r.status, r.owner) for r in prepared.collect()}
    assert found == {
        "ngay_x": ("Conditional NULL", "confirmed", "system"),
        "other": (None, "need_check", "data-owner"),
        "named": ("Valid NULL", "confirmed", "me"),
    }
    assert {r.column_name for r in completeness.warned(columns).collect()} == set(found)
    assert candidates.columns_without_class(columns, prepared).first().column_name == "other"
    assert [r.id for r in candidates.unknown_null_classes(known).collect()] == ["k", "w"]


def test_candidates(spark):
    frame = spark.sql(
        "SELECT DATE'2024-01-01' AS start_day, DATE'2024-01-01' AS to_day, 'x' AS order_state, "
        "'x' AS started, DATE'2024-01-01' AS tomorrow"
    )
    columns = inventory.column_inventory(TableRegistry(spark).add("s", "t", frame))
    dates = candidates.date_order_candidates(columns).collect()
    assert [(r.id, r.start_column, r.end_column) for r in dates] == [
        ("auto-s-t-start_day-to_day-date-order", "start_day", "to_day"),
    ]
    states = candidates.status_candidates(columns).collect()
    assert [r.status_column for r in states] == ["order_state"]
    assert candidates.enum_candidates(columns).first().column == "s.t.order_state"
    kinds = {r.pattern for r in candidates.pattern_candidates(columns).collect()}
    assert kinds == {"date_order", "status_terminal", "total_detail"}


def test_uniqueness_scope(spark):
    columns = spark.createDataFrame(
        [("s", "person", "id", "int", 1, True), ("s", "person", "name", "string", 3, False),
         ("s", "person", "city", "string", 2, False), ("s", "only_ids", "x_id", "int", 1, False),
         ("s", "blog", "text", "string", 1, False), ("s", "minor", "text", "string", 1, False)],
        "schema_name string, table_name string, column_name string, data_type string, "
        "position int, pk boolean",
    )
    tiers = spark.createDataFrame(
        [("s", "person", "1"), ("s", "only_ids", "tier 1"), ("s", "blog", "1"), ("s", "minor", "2")],
        "schema_name string, table_name string, tier string",
    )
    scope = uniqueness.scope(columns, tiers)
    assert [(r.table_name, r.columns) for r in scope.collect()] == [("person", ["city", "name"])]
    left_out = {r.table_name: r.reason for r in uniqueness.out_of_scope(tiers, scope).collect()}
    assert left_out == {"only_ids": "NO_BUSINESS_COLUMN", "blog": "INFRASTRUCTURE"}


def test_jobs_without_rules_report_only_what_is_skipped(spark):
    registry = TableRegistry(spark).add("s", "t", spark.range(2))
    columns = inventory.column_inventory(registry)
    none = inventory.constraints_frame(spark, [])
    tiers = spark.createDataFrame([], "schema_name string, table_name string, tier string")
    found = jobs.consistency_job(registry, columns, none, tiers, rules.rules_frame(spark, []))
    assert [(r.check_id, r.status) for r in found["results"].collect()] == [
        ("business-total-detail", "SKIPPED")
    ]
    flagged = inventory.key_flags(columns, none)
    assert jobs.uniqueness_job(registry, flagged, none, tiers).count() == 0
    assert columns.filter(F.col("column_name") == "id").count() == 1
