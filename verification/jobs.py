"""The end-to-end jobs, saved profiles, rule tables and report files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqloom.operators import inventory, uniqueness
from dqloom.operators.keyed import union_all
from dqloom.plans import jobs, report, runs
from dqloom.sources import refresh, snapshots
from dqloom.sources import rules as rule_source
from verification import completeness as filled
from verification import metadata as described
from verification.consistency import RULES, duplicate_row, keyed_columns, rules_of
from verification.metadata import TAXONOMY
from verification.fixtures import (
    COLUMNS,
    COUNTS,
    PARTS,
    Lab,
    check,
    share,
    with_intake,
)

TABLE = ["schema_name", "table_name"]
COLUMN = [*TABLE, "column_name"]


def _body(name: str) -> str:
    """Oracle text of a registered query as a subquery, its WITH clause inside."""
    return f"({PARTS[name]})"


# --- saved profiles, rules, reports --------------------------------------------------


SUMMARY = """SELECT o_orderstatus, count(*) AS orders, count(DISTINCT o_custkey) AS customers
             FROM orders {0} GROUP BY ALL"""


@check("snapshot_roundtrip", f"""
    SELECT 'first' AS kind, * FROM ({SUMMARY.format("")})
    UNION ALL SELECT 'kept', * FROM ({SUMMARY.format("")})
    UNION ALL SELECT 'refreshed', * FROM ({SUMMARY.format("WHERE o_totalprice > 100000")})""")
def snapshot_roundtrip(lab: Lab) -> DataFrame:
    """A saved summary is read back unless a refresh is asked for."""
    def summary(orders: DataFrame) -> DataFrame:
        return orders.groupBy("o_orderstatus").agg(
            F.count(F.lit(1)).alias("orders"),
            F.count_distinct("o_custkey").alias("customers"),
        )

    orders = lab.given("orders")
    costly = orders.filter(F.col("o_totalprice") > 100000)
    path, other = lab.scratch("snapshot"), lab.scratch("snapshot")
    first = snapshots.load_snapshot(lab.spark, path, lambda: summary(orders))
    kept = snapshots.load_snapshot(lab.spark, path, lambda: summary(costly))
    snapshots.load_snapshot(lab.spark, other, lambda: summary(orders), fmt="json")
    refreshed = snapshots.load_snapshot(
        lab.spark, other, lambda: summary(costly), refresh=True, fmt="json"
    )
    columns = ["o_orderstatus", "orders", "customers"]
    return union_all([
        frame.select(F.lit(kind).alias("kind"), *columns)
        for kind, frame in [("first", first), ("kept", kept), ("refreshed", refreshed)]
    ])


REFRESHED = """
    SELECT '{kind}' AS kind, (SELECT count(*) FROM orders WHERE {read}) AS rows_read, '{c}' AS column_name,
           count(*) AS total_rows, count(*) - count({c}) AS null_count, CAST(min({c}) AS VARCHAR) AS col_min,
           CAST(max({c}) AS VARCHAR) AS col_max, {total} AS col_sum, TRUE AS close,
           {common} AS common_values FROM orders WHERE {held}"""
ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
FEW_VALUES = ("o_orderstatus", "o_orderpriority")
LATER = "o_orderstatus = 'P'"


def _refreshed_sql(kind: str, read: str, held: str) -> str:
    def common(c: str) -> str:
        return (f"(SELECT string_agg(v, ' | ' ORDER BY n DESC, v) FROM (SELECT {c} AS v, count(*) AS n "
                f"FROM orders WHERE {held} GROUP BY ALL HAVING count(*) > 1))")

    return " UNION ALL ".join(
        REFRESHED.format(
            kind=kind, read=read, held=held, c=c, common=common(c) if c in FEW_VALUES else "''",
            total=f"CAST(sum({c}) AS VARCHAR)" if c in ("o_orderkey", "o_custkey") else "''",
        )
        for c in ORDER_COLUMNS
    )


@check("refreshed_profile", " UNION ALL ".join([
    _refreshed_sql("first", f"NOT {LATER}", f"NOT {LATER}"),
    _refreshed_sql("added", LATER, "TRUE"),
    _refreshed_sql("same", "FALSE", "TRUE"),
]))
def refreshed_profile(lab: Lab) -> DataFrame:
    """Orders arrive in two deliveries; after each the profile is refreshed from the new files alone.

    Everything is compared exactly but the sketched distinct counts, which lie within 5 % (or 2).
    """
    orders = lab.given("orders")
    table, state = lab.scratch("delivered"), lab.scratch("statistics")
    late = F.expr(LATER)
    results = []
    for kind, delivery in [("first", orders.filter(~late)), ("added", orders.filter(late)), ("same", None)]:
        if delivery is not None:
            delivery.write.mode("append").parquet(table)
            held = delivery if kind == "first" else orders
            exact = held.agg(*[F.count_distinct(c).alias(c) for c in ORDER_COLUMNS]).unpivot(
                [], [F.col(c) for c in ORDER_COLUMNS], "column_name", "exact"
            )
        found = refresh.refresh_profile(lab.spark, table, state, "sales", "orders")
        read = found.added.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows_read"))
        off = F.abs(F.col("cardinality") - F.col("exact"))
        few = F.col("column_name").isin(*FEW_VALUES)
        results.append(found.profile.join(exact, "column_name").select(
            F.lit(kind).alias("kind"), read.scalar().alias("rows_read"), "column_name", "total_rows", "null_count", "col_min", "col_max",
            F.coalesce("col_sum", F.lit("")).alias("col_sum"),
            ((off <= F.col("exact") * 0.05) | (off <= 2)).alias("close"),
            F.when(few, F.col("common_values")).otherwise(F.lit("")).alias("common_values"),
        ))
    return union_all(results)


@check("nested_profile", f"""
    {with_intake()}
    SELECT schema_name, table_name, row_count, count(*) AS columns,
           string_agg(column_name || ':' || data_type, ',' ORDER BY position) AS listed
    FROM ({COUNTS}) JOIN ({COLUMNS}) USING (schema_name, table_name) GROUP BY ALL""")
def nested_profile(lab: Lab) -> DataFrame:
    """One saved row per table with its columns inside, written and read back."""
    nested = snapshots.nested_profile(
        inventory.row_counts(lab.registry), inventory.column_inventory(lab.registry)
    )
    path = snapshots.save_snapshot(nested, lab.scratch("nested"))
    listed = F.array_join(
        F.transform("columns", lambda c: F.concat_ws(":", c["column_name"], c["data_type"])), ","
    )
    return lab.spark.read.parquet(path).select(
        *TABLE, "row_count", F.size("columns").cast("bigint").alias("columns"),
        listed.alias("listed"),
    )


@check("report_sink", f"""
    WITH d AS (SELECT 'uniqueness' AS dimension, 2 AS step, 'corpus.documents' AS check_id,
                      checked_count, duplicate_row_count AS violation_count
               FROM ({duplicate_row("corpus", "documents", ["text"])})),
    u AS (SELECT 'uniqueness' AS dimension, 4 AS step, 'uq_lineitem' AS check_id, checked_count,
                 duplicate_row_count AS violation_count
          FROM ({duplicate_row("sales", "lineitem", ["l_orderkey", "l_linenumber"])}))
    SELECT * FROM d UNION ALL SELECT * FROM u""")
def report_sink(lab: Lab) -> DataFrame:
    """Results of one step are replaced, those of the other stay."""
    path = lab.scratch("results")
    texts = uniqueness.duplicates(lab.given("documents"), "corpus", "documents", ["text"])
    report.write_results(report.duplicate_results(texts), path)
    for columns in (["l_orderkey"], ["l_orderkey", "l_linenumber"]):
        lines = uniqueness.duplicates(
            lab.given("lineitem"), "sales", "lineitem", columns, "uq_lineitem"
        )
        report.write_results(report.duplicate_results(lines), path)
    return lab.spark.read.parquet(path).select(
        "dimension", F.col("step").cast("int").alias("step"), "check_id", "checked_count",
        "violation_count",
    )


@check("rule_table", f"""
    {with_intake()}
    SELECT id AS rule_id, row_count FROM (VALUES
        {", ".join(f"('{r['id']}', '{(r.get('table') or r.get('column')).split('.')[1]}')"
                   for r in RULES
                   if r["status"] == "confirmed" and r["pattern"] in ("date_order", "enum",
                                                                      "status_terminal"))}
        ) v(id, t) JOIN ({COUNTS}) n ON n.schema_name = 'intake' AND n.table_name = t""")
def rule_table(lab: Lab) -> DataFrame:
    """Rules written as JSON lines and read back; confirmed ones with their table's rows."""
    path = lab.scratch("rules")
    rules_of(lab).write.json(path)
    rules = rule_source.confirmed(rule_source.read_rules(lab.spark, path))
    table = F.coalesce("table", F.substring_index("column", ".", 2))
    counts = inventory.row_counts(lab.registry).select(
        F.concat_ws(".", *TABLE).alias("table"), "row_count"
    )
    return rules.select(F.col("id").alias("rule_id"), table.alias("table")).join(
        counts, "table"
    ).drop("table")


# --- jobs ----------------------------------------------------------------------------


@check("job_metadata", f"""
    {with_intake()}
    SELECT c.schema_name, c.table_name, c.column_name, pk, fk, uq, total_rows, null_pct, distinct_count
    FROM {_body("column_inventory")} c
    JOIN {_body("column_null_pct")} USING (schema_name, table_name, column_name)
    JOIN {_body("column_distinct")} USING (schema_name, table_name, column_name)""")
def job_metadata(lab: Lab) -> DataFrame:
    """The column part of the metadata job, saved and read back."""
    parts = jobs.metadata_profile(lab.registry, lab.constraints, described.PROFILED, sizes=False)
    path = lab.scratch("profile")
    saved = snapshots.load_snapshot(lab.spark, path, lambda: parts["columns"])
    return saved.select(
        *COLUMN, "pk", "fk", "uq", "total_rows", "null_pct", "distinct_count"
    )


@check("grouped_run", f"""
    {with_intake()}
    SELECT kind, item, n, part FROM (
        SELECT 'column' AS kind, table_name || '.' || column_name AS item, total_rows AS n,
               null_count AS part
        FROM {_body("column_null_pct")})
    UNION ALL SELECT 'note', 'open broken.lost_column', 0, 0
    UNION ALL SELECT 'note', 'open broken.no_such_file', 0, 0""")
def grouped_run(lab: Lab) -> DataFrame:
    """NULL counts in groups of eight tables, written once; a table that can't be opened is one note.

    Tables that fail while they are read are covered by tests, as no task of a registered query shall fail.
    """
    registry = lab.fresh_registry()
    registry.add("broken", "lost_column", lambda: lab.given("orders").select("no_such_column"))
    registry.add_files("broken", {"no_such_file": f"{lab.folder}/no_such_file.parquet"})
    run = runs.GroupedRun(lab.spark, lab.scratch("run"), size=8)
    chosen = [*described.PROFILED, ("broken", "lost_column"), ("broken", "no_such_file")]
    units = runs.each_table(run.opened(registry, chosen))
    found = run.rows("nulls", units, lambda group: union_all([
        described.profile.null_share(registry.table(s, t), s, t) for s, t in group
    ]))
    noted = run.notes().select(
        F.lit("note").alias("kind"), F.concat_ws(" ", "name", "unit").alias("item"),
        F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("part"),
    )
    return found.select(
        F.lit("column").alias("kind"), F.concat_ws(".", "table_name", "column_name").alias("item"),
        F.col("total_rows").alias("n"), F.col("null_count").alias("part"),
    ).unionByName(noted)


JOB_TIERS = f"""
    SELECT schema_name, table_name, tier AS t FROM ({filled.PREPARED_ROWS}) WHERE status = 'confirmed'"""
JOB_NULLS = f"""
    SELECT r.schema_name, r.table_name, r.column_name,
           CASE WHEN total > 0 THEN {share("nulls", "total", 1)} END AS null_pct, t
    FROM ({filled.NULL_RATES}) r LEFT JOIN ({JOB_TIERS}) USING (schema_name, table_name)"""


@check("job_completeness", f"""
    {with_intake()}, d AS ({filled.dirty_sql(filled.NULL_TABLES)}), n AS ({JOB_NULLS})
    SELECT n.schema_name, n.table_name, n.column_name, null_pct,
           CASE WHEN t = 1 AND null_pct > 5 THEN 'CRITICAL'
                WHEN t IN (2, 3) AND null_pct > 90 THEN 'SUSPECT' ELSE 'OK' END AS null_warning,
           dirty_value_check,
           CASE WHEN t = 1 AND null_pct > 5 AND column_name = 'customer_id' THEN 'Valid NULL'
                WHEN t = 1 AND null_pct > 5 AND column_name = 'ghi_chu' THEN 'Conditional NULL'
                ELSE '' END AS null_classify
    FROM n JOIN d USING (schema_name, table_name, column_name)""")
def job_completeness(lab: Lab) -> DataFrame:
    keys = filled.NULL_TABLES
    tables = inventory.table_inventory(lab.registry, lab.constraints, sizes=False)
    columns = union_all([
        jobs.profile.null_share(lab.registry.table(s, t), s, t) for s, t in keys
    ])
    no_rules = lab.spark.createDataFrame([], rule_source.NOT_NULL_RULE_SCHEMA)
    found = jobs.completeness_job(
        lab.registry, tables, columns, lab.tiers, filled.null_rules(lab), no_rules, keys
    )
    return found["columns"].select(
        *COLUMN, "null_pct", "null_warning", "dirty_value_check", "null_classify"
    )


STATUS_OF = "CASE WHEN {0} > 0 THEN 'FAILED' ELSE 'PASS' END"


def _results_sql(name: str, step: str, check_id: str, violations: str) -> str:
    return (f"SELECT {step} AS step, {check_id} AS check_id, checked_count, "
            f"{violations} AS violation_count, {STATUS_OF.format(violations)} AS status "
            f"FROM {_body(name)}")


@check("job_consistency", " UNION ALL ".join([
    _results_sql("orphan_by_constraint", "2", "constraint_name", "orphan_count"),
    _results_sql("date_order", "3", "rule_id", "violation_count"),
    _results_sql("total_detail", "3", "rule_id", "violation_count"),
    _results_sql("status_terminal", "3", "rule_id", "violation_count"),
    _results_sql("enum_check", "4", "rule_id", "invalid_count"),
    _results_sql("cross_table_value", "5", "rule_id", "violation_count"),
    f"SELECT NULL, id, 0, 0, 'SKIPPED' FROM {_body('rule_merge')} WHERE status = 'need_check' "
    "AND id <> 'auto-intake-order_record-status-enum'",
    "SELECT NULL, 'auto-intake-order_record-status-enum', 0, 0, 'SKIPPED'",
    "SELECT NULL, 'null-member', 0, 0, 'SKIPPED'",
    "SELECT NULL, 'bad-reference', 0, 0, 'SKIPPED'",
]), shown=["step"])
def job_consistency(lab: Lab) -> DataFrame:
    """All checks at once; pending and invalid rules come back as SKIPPED."""
    columns = inventory.column_inventory(lab.registry)
    found = jobs.consistency_job(
        lab.registry, columns, lab.constraints, lab.tiers, rules_of(lab)
    )
    return found["results"].select(
        "step", "check_id", "checked_count", "violation_count", "status"
    )


@check("job_uniqueness", " UNION ALL ".join([
    _results_sql("technical_duplicates", "2", "schema_name || '.' || table_name",
                 "duplicate_row_count"),
    _results_sql("unique_violations", "4", "constraint_name", "duplicate_row_count"),
    "SELECT NULL, 'intake.item_catalog', 0, 0, 'SKIPPED'",
]), shown=["step"])
def job_uniqueness(lab: Lab) -> DataFrame:
    found = jobs.uniqueness_job(
        lab.registry, keyed_columns(lab), lab.constraints, lab.tiers
    )
    return found.select("step", "check_id", "checked_count", "violation_count", "status")


CHOSEN = "table_name IN ('order_record', 'item_catalog', 'account_archive')"


@check("job_profile_report", f"""
    WITH tables AS (SELECT t.*, label, growth, note, time_info
        FROM {_body("table_inventory")} t
        JOIN {_body("table_taxonomy")} x USING (schema_name, table_name, row_count)
        LEFT JOIN (SELECT * FROM {_body("growth_min_max")} UNION ALL
                   SELECT 'intake', 'item_catalog', NULL, 'NO_TIMESTAMP', '')
             USING (schema_name, table_name)
        WHERE {CHOSEN})
    SELECT 'table' AS kind, table_name AS item, row_count AS n, label AS a,
           note || ' ' || coalesce(CAST(growth AS VARCHAR), '-') AS b FROM tables
    UNION ALL
    SELECT 'column', table_name || '.' || column_name, total_rows, sample, most_common_freqs
    FROM {_body("column_profile")} WHERE table_name IN ('order_record', 'item_catalog')
    UNION ALL SELECT 'column', 'account_archive.' || c, 0, 'EMPTY_TABLE', ''
    FROM (VALUES ('account_id'), ('account_number'), ('balance')) v(c)
    UNION ALL SELECT 'summary', item, n, '', '' FROM (VALUES ('schemas', 1), ('tables', 3),
        ('columns', 13), ('foreign_keys', 1), ('implicit_foreign_keys', 1), ('pii_columns', 1)) v(item, n)""")
def job_profile_report(lab: Lab) -> DataFrame:
    """The report on three chosen tables."""
    found = jobs.profile_report(
        lab.registry, lab.constraints,
        inventory.parse_table_tokens("order_record, intake.item_catalog, account_archive"),
        labels=TAXONOMY,
    )
    growth = F.coalesce(F.col("growth").cast("string"), F.lit("-"))
    tables = found["tables"].select(
        F.lit("table").alias("kind"), F.col("table_name").alias("item"),
        F.col("row_count").alias("n"), F.col("label").alias("a"),
        F.concat_ws(" ", "note", growth).alias("b"),
    )
    columns = found["statistics"].select(
        F.lit("column").alias("kind"), F.concat_ws(".", "table_name", "column_name").alias("item"),
        F.col("total_rows").alias("n"), F.col("sample").alias("a"),
        F.col("most_common_freqs").alias("b"),
    )
    summary = found["summary"].select(
        F.lit("summary").alias("kind"), "item", F.col("count").alias("n"),
        F.lit("").alias("a"), F.lit("").alias("b"),
    )
    return tables.unionByName(columns).unionByName(summary)


ANALYZED = [("sales", "orders", "2024-03-01 00:00:00"), ("web_log", "events", "2024-02-01 12:30:00")]


@check("profile_report_all", f"""
    {with_intake()},
    analyzed AS (SELECT * FROM (VALUES {", ".join(map(str, ANALYZED))}) v(schema_name, table_name, since)),
    found AS (
        SELECT schema_name, table_name, column_name, total_rows, cardinality, null_count, col_min, col_max, sample,
               most_common_freqs FROM {_body("column_profile")}
        UNION ALL SELECT 'intake', 'account_archive', c, 0, 0, 0, '', '', 'EMPTY_TABLE', ''
        FROM (VALUES ('account_id'), ('account_number'), ('balance')) v(c))
    SELECT found.*, coalesce(since, 'never') AS last_analyzed, row_count, label
    FROM found LEFT JOIN analyzed USING (schema_name, table_name)
    JOIN {_body("table_taxonomy")} USING (schema_name, table_name)""")
def profile_report_all(lab: Lab) -> DataFrame:
    """The column report of every table, planned and written in groups of twelve tables."""
    analyzed = lab.spark.createDataFrame(ANALYZED, "schema_name string, table_name string, last_analyze string")
    found = jobs.profile_report(
        lab.registry, lab.constraints, labels=TAXONOMY, run=runs.GroupedRun(lab.spark, lab.scratch("report"), size=12),
        analyzed=analyzed,
    )
    return found["statistics"].select(
        *COLUMN, "total_rows", "cardinality", "null_count", "col_min", "col_max", "sample", "most_common_freqs",
        F.coalesce("last_analyzed", F.lit("never")).alias("last_analyzed"),
    ).join(found["tables"].select(*TABLE, "row_count", "label"), TABLE)
