"""Completeness queries and the life cycle of rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqloom.functions import naming
from dqloom.operators import candidates, completeness, inventory, profile
from dqloom.operators.keyed import union_all
from dqloom.sources import rules as rule_source
from verification.consistency import RULES, TIER_ONE_EDGE_ROWS, edges_of, rules_of
from verification.fixtures import (
    ALL_TABLES,
    COLUMNS,
    COUNTS,
    TIER_ROWS,
    Lab,
    check,
    share,
    values,
    with_intake,
)
from verification.metadata import _types

TABLE = ["schema_name", "table_name"]
COLUMN = [*TABLE, "column_name"]
DIRTY_TABLES = ALL_TABLES


def _dirty_where(column: str, kind: str) -> str:
    return {
        "s": f"lower(trim({column})) IN ('', 'n/a', '.', '-', '_', 'unknown', 'x')",
        "n": f"CAST({column} AS VARCHAR) IN ('0', '-1', '9999')",
        "d": f"(CAST({column} AS VARCHAR) LIKE '1900-01-01%' OR CAST({column} AS VARCHAR) LIKE '1970-01-01%')",
        "a": "FALSE",
    }[kind]


FAILED = (
    "'Failed: ' || count(*) || ' value(s), ' || sum(n) || ' row(s) (' || printf('%.2f', "
    "CAST(sum(n) AS DOUBLE) / CAST((SELECT count(*) FROM {t}) AS DOUBLE) * 100) || '%)'"
)


def dirty_sql(keys) -> str:
    return " UNION ALL ".join(
        f"""
        SELECT '{s}' AS schema_name, '{t}' AS table_name, '{c}' AS column_name,
               CASE WHEN count(*) = 0 THEN 'Pass' ELSE {FAILED.format(t=t)} END AS dirty_value_check
        FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM {t}
              WHERE {c} IS NOT NULL AND {_dirty_where(c, kind)} GROUP BY ALL)"""
        for s, t in keys for c, kind in _types(t)
    )


def dirty_value_sql(keys) -> str:
    return " UNION ALL ".join(
        f"""
        SELECT '{s}' AS schema_name, '{t}' AS table_name, '{c}' AS column_name,
               CAST({c} AS VARCHAR) AS value, count(*) AS n FROM {t}
        WHERE {c} IS NOT NULL AND {_dirty_where(c, kind)} GROUP BY ALL"""
        for s, t in keys for c, kind in _types(t)
    )


@check("dirty_value_counts", f"{with_intake()} {dirty_value_sql(DIRTY_TABLES)}")
def dirty_value_counts(lab: Lab) -> DataFrame:
    return completeness.dirty_value_counts(lab.registry, DIRTY_TABLES)


@check("dirty_values", f"{with_intake()} {dirty_sql(DIRTY_TABLES)}")
def dirty_values(lab: Lab) -> DataFrame:
    return completeness.dirty_values_of(lab.registry, DIRTY_TABLES)


@check("dirty_values_by_value", """
    WITH t AS (SELECT c_custkey, CASE WHEN c_mktsegment = 'FURNITURE' THEN 0.0::DOUBLE
                                      WHEN c_mktsegment = 'MACHINERY' THEN -1.0::DOUBLE
                                      ELSE c_acctbal END AS balance FROM customer),
    found AS (SELECT balance, count(*) AS n FROM t WHERE balance IN (0, -1, 9999) GROUP BY ALL)
    SELECT 'sales' AS schema_name, 'balances' AS table_name, 'balance' AS column_name,
           'Failed: ' || count(*) || ' value(s), ' || sum(n) || ' row(s) (' || printf('%.2f',
               CAST(sum(n) AS DOUBLE) / CAST((SELECT count(*) FROM t) AS DOUBLE) * 100) || '%)'
               AS dirty_value_check FROM found""")
def dirty_values_by_value(lab: Lab) -> DataFrame:
    """The option that compares numbers by value instead of by text."""
    balance = (
        F.when(F.col("c_mktsegment") == "FURNITURE", F.lit(0.0))
        .when(F.col("c_mktsegment") == "MACHINERY", F.lit(-1.0))
        .otherwise(F.col("c_acctbal"))
    )
    frame = lab.given("customer").select(balance.alias("balance"))
    return completeness.dirty_values(frame, "sales", "balances", by_value=True)


# --- tiers ---------------------------------------------------------------------------


TIER3 = "(^|_)(log|audit|history|histor|temp|tmp)(_|$)"
TIER2 = ("(^|_)(dm|danh_muc|danhmuc|catalog|lookup|config|setting|parameter|permission|role|user|"
         "account|menu|module|function|sys)(_|$)")
SUGGESTED = (f"CASE WHEN regexp_matches(lower(table_name), '{TIER3}') THEN 3 "
             f"WHEN regexp_matches(lower(table_name), '{TIER2}') THEN 2 END")
PREPARED_ROWS = f"""
    SELECT schema_name, table_name, row_count,
           coalesce(assigned, suggested) AS tier,
           CASE WHEN coalesce(assigned, suggested) IS NULL THEN 'need_check' ELSE 'confirmed' END AS status,
           CASE WHEN assigned IS NULL AND suggested IS NOT NULL THEN 'system' ELSE 'data-owner' END AS owner,
           schema_name || '-' || table_name || '-tier' AS id
    FROM (SELECT n.*, {SUGGESTED} AS suggested,
                 CASE WHEN tier IN ('1', '2', '3') THEN CAST(tier AS INTEGER) END AS assigned
          FROM ({COUNTS}) n LEFT JOIN {TIER_ROWS} USING (schema_name, table_name))"""


def prepared_tiers(lab: Lab) -> DataFrame:
    return candidates.prepare_tiers(lab.registry.tables(), lab.tiers)


@check("table_tier", f"{with_intake()} {PREPARED_ROWS}", shown=["tier"])
def table_tier(lab: Lab) -> DataFrame:
    return prepared_tiers(lab).join(inventory.row_counts(lab.registry), TABLE)


@check("tier_lookup", f"""
    {with_intake()}
    SELECT schema_name, table_name, row_count,
           coalesce(CAST(tier AS VARCHAR), 'need_check') AS classification FROM ({PREPARED_ROWS})""")
def tier_lookup(lab: Lab) -> DataFrame:
    confirmed = prepared_tiers(lab).filter(F.col("status") == "confirmed")
    return candidates.classify_tables(inventory.row_counts(lab.registry), confirmed)


@check("tier_gate", f"""
    {with_intake()}
    SELECT schema_name, table_name, row_count FROM ({COUNTS})
    WHERE (schema_name, table_name) NOT IN (
        SELECT (schema_name, table_name) FROM {TIER_ROWS} WHERE tier IN ('1', '2', '3'))""")
def tier_gate(lab: Lab) -> DataFrame:
    """Tables that keep the tier gate closed, with their rows."""
    counts = inventory.row_counts(lab.registry)
    return candidates.tables_without_tier(lab.registry.tables(), lab.tiers).join(counts, TABLE)


EXTRA_TIERS = [("sales", "orders", "2"), ("sales", "part", "tier 1"), ("sales", "lineitem", "")]


@check("tier_conflicts", f"""
    {with_intake()}
    SELECT n.*, problem FROM ({COUNTS}) n JOIN (VALUES
        ('sales', 'orders', 'CONFLICT'), ('sales', 'lineitem', 'INCOMPLETE'))
        v(schema_name, table_name, problem) USING (schema_name, table_name)""")
def tier_conflicts(lab: Lab) -> DataFrame:
    extra = lab.spark.createDataFrame(
        [("x", "confirmed", "data-owner", s, t, tier) for s, t, tier in EXTRA_TIERS],
        rule_source.TIER_SCHEMA,
    )
    problems = rule_source.tier_conflicts(lab.tiers.unionByName(extra))
    return problems.join(inventory.row_counts(lab.registry), TABLE)


@check("tier_values", """
    WITH raw AS (SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN '1' WHEN '2-HIGH'
                 THEN 'Tier 1' WHEN '3-MEDIUM' THEN '1.0' WHEN '4-NOT SPECIFIED' THEN '7'
                 ELSE 'nhóm 2' END AS tier FROM orders)
    SELECT tier, count(*) AS n, max(CASE WHEN tier = '1' THEN 1 END) AS normalized,
           tier IN ('1', 'Tier 1', '1.0') AS tier_one FROM raw GROUP BY ALL""", shown=["normalized"])
def tier_values(lab: Lab) -> DataFrame:
    """Both readings of a tier text, over texts derived from the order priorities."""
    priority = F.col("o_orderpriority")
    tier = (
        F.when(priority == "1-URGENT", "1").when(priority == "2-HIGH", "Tier 1")
        .when(priority == "3-MEDIUM", "1.0").when(priority == "4-NOT SPECIFIED", "7")
        .otherwise("nhóm 2")
    )
    raw = lab.given("orders").select(tier.alias("tier"))
    return raw.groupBy("tier").agg(
        F.count(F.lit(1)).alias("n"),
        F.max(naming.normalized_tier(F.col("tier"))).alias("normalized"),
        F.bool_or(naming.is_tier_one(F.col("tier"))).alias("tier_one"),
    )


# --- NULLs ---------------------------------------------------------------------------


NULL_TABLES = ALL_TABLES
# a second tier list: one table is demoted so that both warnings occur
NULL_TIERS = [("intake", "order_record", "1"), ("intake", "customer_record", "2"),
              ("intake", "item_catalog", "1")]
NULL_RULES = [
    ("r1", "confirmed", "data-owner", "intake", "order_record", "customer_id", " Valid NULL "),
    ("r2", "need_check", "data-owner", "intake", "customer_record", "segment_code", None),
]
NULL_RATES = " UNION ALL ".join(
    f"SELECT '{s}' AS schema_name, '{t}' AS table_name, '{c}' AS column_name, "
    f"count(*) AS total, count(*) - count({c}) AS nulls FROM {t}"
    for s, t in NULL_TABLES for c, _ in _types(t)
)
WARNED_ROWS = f"""
    SELECT schema_name, table_name, column_name, null_pct, tier AS table_tier,
           CASE WHEN tier = '1' AND null_pct > 5 THEN 'CRITICAL'
                WHEN tier IN ('2', '3') AND null_pct > 90 THEN 'SUSPECT' ELSE 'OK' END AS null_warning
    FROM (SELECT r.*, CASE WHEN total > 0 THEN {share("nulls", "total", 1)} END AS null_pct
          FROM ({NULL_RATES}) r)
    LEFT JOIN {values(NULL_TIERS, "schema_name, table_name, tier")} USING (schema_name, table_name)"""


def warned_columns(lab: Lab) -> DataFrame:
    nulls = union_all([profile.null_share(lab.registry.table(s, t), s, t) for s, t in NULL_TABLES])
    tiers = lab.spark.createDataFrame(NULL_TIERS, "schema_name string, table_name string, tier string")
    return completeness.with_null_warning(nulls, tiers)


def null_rules(lab: Lab) -> DataFrame:
    return lab.spark.createDataFrame(NULL_RULES, rule_source.NULL_RULE_SCHEMA)


@check("null_warning", f"{with_intake()} {WARNED_ROWS}")
def null_warning(lab: Lab) -> DataFrame:
    return warned_columns(lab).select(*COLUMN, "null_pct", "table_tier", "null_warning")


@check("null_classification", f"""
    {with_intake()}
    SELECT CASE column_name WHEN 'customer_id' THEN 'r1'
                ELSE 'auto-' || schema_name || '-' || table_name || '-' || column_name END AS id,
           schema_name, table_name, column_name,
           CASE column_name WHEN 'customer_id' THEN 'Valid NULL' WHEN 'ghi_chu' THEN 'Conditional NULL'
                END AS null_classify,
           CASE WHEN column_name IN ('customer_id', 'ghi_chu') THEN 'confirmed' ELSE 'need_check' END AS status,
           CASE column_name WHEN 'ghi_chu' THEN 'system' ELSE 'data-owner' END AS owner
    FROM ({WARNED_ROWS}) WHERE null_warning <> 'OK'""")
def null_classification(lab: Lab) -> DataFrame:
    return candidates.prepare_null_rules(warned_columns(lab), null_rules(lab))


@check("null_gate", f"""
    {with_intake()}
    SELECT schema_name, table_name, column_name FROM ({WARNED_ROWS})
    WHERE null_warning <> 'OK' AND column_name <> 'customer_id'""")
def null_gate(lab: Lab) -> DataFrame:
    """Warned columns that keep the gate closed: rules as they are before suggestions."""
    return candidates.columns_without_class(warned_columns(lab), null_rules(lab))


@check("column_lookup", f"""
    {with_intake()}, d AS ({dirty_sql(NULL_TABLES)})
    SELECT w.schema_name, w.table_name, w.column_name, null_warning, dirty_value_check,
           CASE WHEN column_name = 'order_id' AND table_name = 'order_record' THEN 'yes' ELSE '' END AS not_nullable,
           CASE WHEN column_name = 'customer_id' AND table_name = 'order_record' THEN ' Valid NULL '
                ELSE '' END AS null_classify
    FROM ({WARNED_ROWS}) w JOIN d USING (schema_name, table_name, column_name)""")
def column_lookup(lab: Lab) -> DataFrame:
    """Confirmed not-null and NULL-class rules and placeholder checks looked up per column."""
    not_null = lab.spark.createDataFrame(
        [("n1", "confirmed", "data-owner", "intake", "order_record", "order_id", "yes"),
         ("n2", "need_check", "data-owner", "intake", "order_record", "status", "yes")],
        rule_source.NOT_NULL_RULE_SCHEMA,
    )
    dirty = completeness.dirty_values_of(lab.registry, NULL_TABLES)
    found = completeness.classify_columns(warned_columns(lab), not_null, null_rules(lab), dirty)
    return found.select(*COLUMN, "null_warning", "dirty_value_check", "not_nullable",
                        "null_classify")


@check("table_fill", f"""
    {with_intake()}
    SELECT *, CASE WHEN row_count = 0 THEN 'EMPTY' WHEN row_count < 1000 THEN 'SMALL'
                   ELSE 'POPULATED' END AS fill_class FROM ({COUNTS})""")
def table_fill(lab: Lab) -> DataFrame:
    return completeness.fill_class(inventory.row_counts(lab.registry))


@check("null_by_condition", f"""
    {with_intake("order_record")}
    SELECT status AS condition_value, count(*) AS null_count FROM order_record
    WHERE customer_id IS NULL GROUP BY ALL""")
def null_by_condition(lab: Lab) -> DataFrame:
    return completeness.null_by_condition(lab.intake("order_record"), "customer_id", "status")


# --- rule candidates and gates -------------------------------------------------------


START = "(^|_)(start|begin|from|vao|bat_dau|tu)(_|$)"
END = "(^|_)(end|finish|to|ra|ket_thuc|den)(_|$)"
STATUS = "(^|_)(status|state|trang_thai|tinh_trang)(_|$)"
ENUM = "(^|_)(loai|tinh_trang|trang_thai|gioi_tinh|nhom_mau|status|state)(_|$)"


@check("date_rule_candidates", f"""
    {with_intake()}
    SELECT 'auto-' || s.schema_name || '-' || s.table_name || '-' || s.column_name || '-' ||
           e.column_name || '-date-order' AS id, 'need_check' AS status,
           s.schema_name || '.' || s.table_name AS "table", s.column_name AS start_column,
           e.column_name AS end_column, '<' AS operator, row_count
    FROM ({COLUMNS}) s JOIN ({COLUMNS}) e USING (schema_name, table_name)
    JOIN ({COUNTS}) USING (schema_name, table_name)
    WHERE s.data_type = 'timestamp_ntz' AND e.data_type = 'timestamp_ntz'
      AND regexp_matches(s.column_name, '{START}') AND regexp_matches(e.column_name, '{END}')""")
def date_rule_candidates(lab: Lab) -> DataFrame:
    found = candidates.date_order_candidates(inventory.column_inventory(lab.registry))
    counts = inventory.row_counts(lab.registry).select(
        F.concat_ws(".", *TABLE).alias("table"), "row_count"
    )
    return found.select(
        "id", "status", "table", "start_column", "end_column", "operator"
    ).join(counts, "table")


def _named_candidates(pattern: str, suffix: str) -> str:
    return f"""
        SELECT 'auto-' || schema_name || '-' || table_name || '-' || column_name || '-{suffix}' AS id,
               schema_name || '.' || table_name || '.' || column_name AS "column", row_count
        FROM ({COLUMNS}) JOIN ({COUNTS}) USING (schema_name, table_name)
        WHERE regexp_matches(column_name, '{pattern}', 'i')"""


@check("status_rule_candidates", f"{with_intake()} {_named_candidates(STATUS, 'status')}")
def status_rule_candidates(lab: Lab) -> DataFrame:
    found = candidates.status_candidates(inventory.column_inventory(lab.registry))
    counts = inventory.row_counts(lab.registry).select(
        F.concat_ws(".", *TABLE).alias("table"), "row_count"
    )
    return found.join(counts, "table").select(
        "id", F.concat_ws(".", "table", "status_column").alias("column"), "row_count"
    )


@check("enum_rule_candidates", f"{with_intake()} {_named_candidates(ENUM, 'enum')}")
def enum_rule_candidates(lab: Lab) -> DataFrame:
    found = candidates.enum_candidates(inventory.column_inventory(lab.registry))
    counts = inventory.row_counts(lab.registry).select(
        F.concat_ws(".", *TABLE).alias("table"), "row_count"
    )
    table = F.substring_index("column", ".", 2).alias("table")
    return found.select("id", "column", table).join(counts, "table").drop("table")


CROSS_ROWS = f"""
    SELECT 'auto-' || from_schema || '-' || from_table || '-' || to_table || '-' || c.column_name
           || '-cross-table' AS id,
           to_schema || '.' || to_table || '.' || c.column_name AS source,
           from_schema || '.' || from_table || '.' || c.column_name AS target,
           string_agg(DISTINCT to_schema || '.' || to_table || '.' || to_column || '=' ||
                      from_schema || '.' || from_table || '.' || from_column, ',') AS pairs
    FROM ({TIER_ONE_EDGE_ROWS}) e
    JOIN ({COLUMNS}) c ON c.schema_name = from_schema AND c.table_name = from_table
    JOIN ({COLUMNS}) p ON p.schema_name = to_schema AND p.table_name = to_table
     AND p.column_name = c.column_name
    GROUP BY ALL HAVING NOT bool_or(c.column_name = from_column)"""


@check("cross_rule_candidates", f"""
    {with_intake()}
    SELECT r.*, row_count FROM ({CROSS_ROWS}) r JOIN ({COUNTS})
      ON schema_name || '.' || table_name = regexp_extract(source, '^[^.]*[.][^.]*')""")
def cross_rule_candidates(lab: Lab) -> DataFrame:
    found = candidates.cross_table_candidates(
        inventory.column_inventory(lab.registry), edges_of(lab)
    )
    pairs = F.array_join(
        F.transform("join", lambda p: F.concat_ws("=", p["source"], p["target"])), ","
    )
    counts = inventory.row_counts(lab.registry).select(
        F.concat_ws(".", *TABLE).alias("table"), "row_count"
    )
    return found.select(
        "id", "source", "target", pairs.alias("pairs"),
        F.substring_index("source", ".", 2).alias("table"),
    ).join(counts, "table").drop("table")


def merged_rules(lab: Lab) -> DataFrame:
    """Existing rules, of which one already has a candidate's id, and all candidates."""
    known = rule_source.rules_frame(lab.spark, [
        *RULES,
        dict(id="auto-intake-order_record-status-enum", dimension="consistency",
             step="enum_check", status="confirmed", pattern="enum",
             column="intake.order_record.status", allowed_values=["F"]),
    ])
    columns = inventory.column_inventory(lab.registry)
    proposed = candidates.pattern_candidates(columns).unionByName(
        candidates.enum_candidates(columns), allowMissingColumns=True
    ).unionByName(
        candidates.cross_table_candidates(columns, edges_of(lab)), allowMissingColumns=True
    )
    return rule_source.merge_new(known, proposed)


EXISTING_ROWS = values([(r["id"], r["step"], r["status"]) for r in RULES], "id, step, status")
MERGED_ROWS = f"""
    SELECT id, step, status FROM {EXISTING_ROWS}
    UNION ALL SELECT 'auto-intake-order_record-status-enum', 'enum_check', 'confirmed'
    UNION ALL SELECT 'business-total-detail', 'pattern_check', 'need_check'
    UNION ALL SELECT 'auto-' || s.schema_name || '-' || s.table_name || '-' || s.column_name || '-' ||
           e.column_name || '-date-order', 'pattern_check', 'need_check'
        FROM ({COLUMNS}) s JOIN ({COLUMNS}) e USING (schema_name, table_name)
        WHERE s.data_type = 'timestamp_ntz' AND e.data_type = 'timestamp_ntz'
          AND regexp_matches(s.column_name, '{START}') AND regexp_matches(e.column_name, '{END}')
    UNION ALL SELECT id, 'pattern_check', 'need_check' FROM ({_named_candidates(STATUS, "status")})
    UNION ALL SELECT id, 'enum_check', 'need_check' FROM ({_named_candidates(ENUM, "enum")})
        WHERE id <> 'auto-intake-order_record-status-enum'
    UNION ALL SELECT id, 'cross_table_check', 'need_check' FROM ({CROSS_ROWS})"""


@check("rule_merge", f"{with_intake()} {MERGED_ROWS}")
def rule_merge(lab: Lab) -> DataFrame:
    return merged_rules(lab).select("id", "step", "status")


@check("rule_readiness", f"""
    {with_intake()}
    SELECT 'consistency' AS dimension, step, count(id) AS rule_count,
           count(*) FILTER (WHERE status = 'confirmed') AS confirmed_count,
           count(*) FILTER (WHERE status = 'confirmed') > 0 AS may_start,
           count(*) FILTER (WHERE status = 'confirmed') = count(id) AS all_confirmed
    FROM (VALUES ('pattern_check'), ('enum_check'), ('cross_table_check'), ('nothing_yet')) s(step)
    LEFT JOIN ({MERGED_ROWS}) USING (step) GROUP BY ALL""")
def rule_readiness(lab: Lab) -> DataFrame:
    steps = lab.spark.createDataFrame(
        [("consistency", s) for s in
         ("pattern_check", "enum_check", "cross_table_check", "nothing_yet")],
        "dimension string, step string",
    )
    return rule_source.readiness(merged_rules(lab), steps)


@check("document_status", f"""
    {with_intake()}
    SELECT step, CASE WHEN bool_or(status = 'confirmed') THEN 'confirmed' ELSE 'draft' END AS status
    FROM ({MERGED_ROWS}) GROUP BY ALL""")
def document_status(lab: Lab) -> DataFrame:
    return rule_source.document_status(merged_rules(lab), ["step"])


@check("rule_validation", f"""
    {with_intake()}
    SELECT id AS rule_id, 'missing event_time_column' AS error FROM ({_named_candidates(STATUS, "status")})
    UNION ALL SELECT id, 'missing entity_columns' FROM ({_named_candidates(STATUS, "status")})
    UNION ALL SELECT id, 'missing terminal_values' FROM ({_named_candidates(STATUS, "status")})
    UNION ALL SELECT id, 'require_terminal is not a boolean' FROM ({_named_candidates(STATUS, "status")})
    UNION ALL SELECT id, 'missing allowed_values' FROM ({_named_candidates(ENUM, "enum")})
        WHERE id <> 'auto-intake-order_record-status-enum'
    UNION ALL SELECT * FROM (VALUES
        ('business-total-detail', 'missing total_table'),
        ('business-total-detail', 'missing total_column'),
        ('business-total-detail', 'missing detail_table'),
        ('business-total-detail', 'missing detail_column'),
        ('business-total-detail', 'missing join_columns'),
        ('null-member', 'NULL in allowed_values'),
        ('bad-reference', 'expected schema.table.column: order_record.status'),
        ('bad-reference', 'invalid join reference'),
        ('bad-reference', 'unsupported null_policy')) v(rule_id, error)""")
def rule_validation(lab: Lab) -> DataFrame:
    """Everything wrong with the merged rules; candidates derived from the tables included."""
    return rule_source.validation_errors(merged_rules(lab))


# --- what rules name ------------------------------------------------------------------


def _named_columns() -> list[tuple[str, str, str, str]]:
    """Rule and column of everything the rules compare."""
    within = {
        "date_order": [("table", "start_column"), ("table", "end_column")],
        "status_terminal": [("table", "status_column"), ("table", "event_time_column")],
        "total_detail": [("total_table", "total_column"), ("detail_table", "detail_column")],
        "enum": [("column",)], "duplicated_value": [("source",), ("target",)],
    }
    found = []
    for rule in RULES:
        for names in within.get(rule.get("pattern"), []):
            parts = ".".join(rule.get(n) or "" for n in names).split(".")
            if len(parts) == 3:
                found.append((rule["id"], *parts))
    return found


@check("rule_references", f"""
    {with_intake()},
    named AS {values(_named_columns(), "rule_id, schema_name, table_name, column_name")},
    counted AS ({" UNION ALL ".join(
        f"SELECT '{s}' AS schema_name, '{t}' AS table_name, '{c}' AS column_name, "
        f"count(*) AS total_rows, count(*) - count({c}) AS null_count FROM {t}"
        for s, t in ALL_TABLES for c, _ in _types(t))})
    SELECT n.*, total_rows, null_count, CASE WHEN total_rows IS NULL THEN
        'unknown column ' || schema_name || '.' || table_name || '.' || column_name ELSE '' END AS error
    FROM named n LEFT JOIN counted USING (schema_name, table_name, column_name)""",
    shown=["total_rows", "null_count"])
def rule_references(lab: Lab) -> DataFrame:
    """What the rules compare, with the rows and NULLs found there, and what does not exist."""
    by = ["schema_name", "table_name", "column_name"]
    named = rule_source.references(rules_of(lab))
    lost = rule_source.unknown_references(rules_of(lab), inventory.column_inventory(lab.registry))
    counted = union_all([
        profile.null_share(lab.registry.table(s, t), s, t) for s, t in ALL_TABLES
    ]).select(*by, "total_rows", "null_count")
    text = F.concat(F.lit("unknown column "), F.concat_ws(".", *by))
    marked = lost.distinct().withColumnRenamed("error", "_error")
    joined = named.join(counted, by, "left").withColumn("_error", text).join(
        marked.withColumn("_lost", F.lit(True)), ["rule_id", "_error"], "left"
    )
    return joined.select(
        "rule_id", *by, "total_rows", "null_count",
        F.when(F.col("_lost"), F.col("_error")).otherwise(F.lit("")).alias("error"),
    )
