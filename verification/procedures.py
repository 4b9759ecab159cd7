"""Documented procedures: accuracy, timeliness, validity, integrity, history, lineage."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqloom.operators import (
    accuracy,
    consistency,
    integrity,
    inventory,
    lineage,
    temporal,
    timeliness,
    uniqueness,
    validity,
)
from dqloom.operators.inventory import FOREIGN_KEY, constraints_frame, key_rows
from dqloom.operators.keyed import union_all
from dqloom.sources import rules as rule_source
from verification.completeness import MERGED_ROWS, merged_rules
from verification.consistency import EDGE_ROWS, planned
from verification.fixtures import (
    COLUMNS,
    COUNTS,
    Lab,
    check,
    share,
    with_intake,
)

TABLE = ["schema_name", "table_name"]


@check("activity_after_closing", f"""
    WITH closed AS (SELECT user_id, max(ts) AS at FROM events WHERE event_type = 'purchase' GROUP BY ALL),
    n AS (SELECT count(*) AS c, count(*) FILTER (WHERE e.ts > closed.at) AS v
          FROM events e JOIN closed USING (user_id))
    SELECT c AS checked_count, v AS violation_count, {share("v", "c")} AS violation_pct FROM n""")
def activity_after_closing(lab: Lab) -> DataFrame:
    return consistency.activity_after_closing(
        lab.given("events"), ["user_id"], "event_type", "ts", ["purchase"]
    )


NAME_SQL = ("trim(regexp_replace(replace(lower(strip_accents({0})), 'đ', 'd'), '\\s+', ' ', 'g'))")


@check("business_key_duplicates", f"""
    WITH keys AS (SELECT {NAME_SQL.format("text")} AS text, lang FROM documents),
    sizes AS (SELECT count(*) AS n FROM keys WHERE text IS NOT NULL GROUP BY text, lang),
    sums AS (SELECT sum(n)::BIGINT AS c, count(*) FILTER (WHERE n > 1) AS g,
                    coalesce(sum(n) FILTER (WHERE n > 1), 0)::BIGINT AS r FROM sizes)
    SELECT 'corpus' AS schema_name, 'documents' AS table_name, 'text, lang' AS columns,
           c AS checked_count, g AS duplicate_group_count, r AS duplicate_row_count,
           {share("r", "c")} AS duplicate_pct FROM sums""")
def business_key_duplicates(lab: Lab) -> DataFrame:
    """Whole texts compared without accents, case and spacing."""
    return uniqueness.business_key_duplicates(
        lab.given("documents"), "corpus", "documents",
        {"text": uniqueness.unaccented(F.col("text")), "lang": F.col("lang")},
    )


@check("duplicate_impact", f"""
    WITH n AS (SELECT *, count(*) OVER (PARTITION BY o_custkey, o_orderpriority) AS g FROM orders),
    m AS (SELECT strftime(o_orderdate, '%Y-%m') AS period, count(*) AS c,
                 count(*) FILTER (WHERE g > 1) AS r FROM n GROUP BY ALL)
    SELECT period, c AS checked_count, r AS duplicate_row_count, {share("r", "c")} AS duplicate_pct
    FROM m""")
def duplicate_impact(lab: Lab) -> DataFrame:
    return uniqueness.duplicate_impact(
        lab.given("orders"), ["o_custkey", "o_orderpriority"],
        F.date_format("o_orderdate", "yyyy-MM"),
    )


# --- accuracy ------------------------------------------------------------------------


@check("unknown_codes", """
    SELECT l_partkey AS code, count(*) AS affected_rows FROM lineitem
    WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 25) GROUP BY ALL""")
def unknown_codes(lab: Lab) -> DataFrame:
    reference = lab.given("part").filter(F.col("p_size") <= 25)
    return accuracy.unknown_codes(lab.given("lineitem"), reference, "l_partkey", "p_partkey")


@check("stratified_sample", """
    SELECT o_orderkey, o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS y FROM (
        SELECT *, row_number() OVER (PARTITION BY o_orderstatus, year(o_orderdate)
            ORDER BY md5(o_orderkey || '|7'), o_orderkey) AS rn FROM orders)
    WHERE rn <= 5""")
def stratified_sample(lab: Lab) -> DataFrame:
    """Five orders per status and year; the size is what a sample is."""
    sample = accuracy.stratified_sample(
        lab.given("orders"), [F.col("o_orderstatus"), F.year("o_orderdate")], ["o_orderkey"], 5, 7
    )
    return sample.select("o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("y"))


@check("coverage_note", f"""
    {with_intake()},
    gates AS (SELECT step, count(id) AS rules, count(*) FILTER (WHERE status = 'confirmed') AS confirmed
              FROM (VALUES ('pattern_check'), ('enum_check'), ('cross_table_check'), ('nothing_yet')) s(step)
              LEFT JOIN ({MERGED_ROWS}) USING (step) GROUP BY ALL),
    ran AS (SELECT 'enum_check' AS step, CAST(3 AS BIGINT) AS checks_run,
                   (SELECT count(status) FROM order_record) + (SELECT count(return_status) FROM order_line)
                   + (SELECT count(status) FROM order_copy) AS rows_checked)
    SELECT 'consistency' AS dimension, step, coalesce(checks_run, 0) AS checks_run,
           coalesce(rows_checked, 0) AS rows_checked,
           CASE WHEN checks_run > 0 THEN 'CHECKED' WHEN rules = 0 THEN 'NO_RULES'
                WHEN confirmed = 0 THEN 'NOT_CONFIRMED' ELSE 'NOT_RUN' END AS coverage
    FROM gates LEFT JOIN ran USING (step)""")
def coverage_note(lab: Lab) -> DataFrame:
    steps = lab.spark.createDataFrame(
        [("consistency", s) for s in
         ("pattern_check", "enum_check", "cross_table_check", "nothing_yet")],
        "dimension string, step string",
    )
    results = consistency.enum_checks(lab.registry, planned(lab, "enum")).select(
        F.lit("consistency").alias("dimension"), F.lit("enum_check").alias("step"),
        "checked_count",
    )
    return accuracy.coverage_note(rule_source.readiness(merged_rules(lab), steps), results)


# --- timeliness ----------------------------------------------------------------------


def _activity_sql(schema: str, table: str, column: str) -> str:
    return f"""
        SELECT '{schema}' AS schema_name, '{table}' AS table_name, CAST(newest AS VARCHAR) AS newest,
               age AS age_days, CASE WHEN newest IS NULL THEN 'EMPTY' WHEN age <= 30 THEN 'ACTIVE'
                   WHEN age <= 3000 THEN 'DOUBTFUL' ELSE 'ABANDONED' END AS activity
        FROM (SELECT newest, CAST(datediff('day', newest, DATE '2024-02-15') AS INTEGER) AS age
              FROM (SELECT max({column}) AS newest FROM {table}))"""


@check("table_activity", f"""
    {_activity_sql("web_log", "events", "ts")} UNION ALL
    {_activity_sql("sales", "orders", "o_orderdate")} UNION ALL
    {_activity_sql("sales", "lineitem", "l_shipdate")}""")
def table_activity(lab: Lab) -> DataFrame:
    return union_all([
        timeliness.table_activity(
            lab.registry.table(s, t), s, t, c, "2024-02-15", doubtful_days=3000
        )
        for s, t, c in [("web_log", "events", "ts"), ("sales", "orders", "o_orderdate"),
                        ("sales", "lineitem", "l_shipdate")]
    ])


@check("entry_latency", f"""
    {with_intake("order_line")},
    d AS (SELECT datediff('second', start_date, end_date) AS s FROM order_line),
    q AS (SELECT quantile_disc(s, 0.25) AS q1, quantile_disc(s, 0.5) AS q2,
                 quantile_disc(s, 0.75) AS q3 FROM d)
    SELECT count(*) AS checked_count,
           round(CAST(sum(s) AS DOUBLE) / count(*), 3) AS mean_seconds, any_value(q2) AS median_seconds,
           max(s) AS max_seconds, count(*) FILTER (WHERE s < 0) AS negative_count,
           count(*) FILTER (WHERE s > q3 + 1.5 * (q3 - q1)) AS outlier_count FROM d, q""")
def entry_latency(lab: Lab) -> DataFrame:
    return timeliness.entry_latency(lab.intake("order_line"), "start_date", "end_date")


@check("coverage_gaps", """
    WITH days AS (SELECT DISTINCT o_orderstatus, CAST(o_orderdate AS DATE) AS d
                  FROM orders WHERE o_totalprice > 400000),
    gaps AS (SELECT *, datediff('day', d, lead(d) OVER (PARTITION BY o_orderstatus ORDER BY d)) AS gap
             FROM days)
    SELECT o_orderstatus, CAST(min(d) AS VARCHAR) AS oldest, CAST(max(d) AS VARCHAR) AS newest,
           count(*) AS days_with_data, count(*) FILTER (WHERE gap > 1) AS gap_count,
           coalesce(max(gap) FILTER (WHERE gap > 1), 0)::INTEGER AS longest_gap_days
    FROM gaps GROUP BY ALL""")
def coverage_gaps(lab: Lab) -> DataFrame:
    costly = lab.given("orders").filter(F.col("o_totalprice") > 400000)
    return timeliness.coverage_gaps(costly, "o_orderdate", ["o_orderstatus"])


@check("frequency_outliers", """
    WITH m AS (SELECT date_trunc('month', l_shipdate) AS p, count(*) AS n FROM lineitem GROUP BY ALL),
    s AS (SELECT avg(n) AS mean, stddev_samp(n) AS dev FROM m)
    SELECT strftime(p, '%Y-%m-%d') AS period, n AS row_count,
           CASE WHEN n - mean > 2 * dev THEN 'HIGH' WHEN n - mean < -2 * dev THEN 'LOW'
                ELSE 'USUAL' END AS frequency FROM m, s""")
def frequency_outliers(lab: Lab) -> DataFrame:
    return timeliness.frequency_outliers(lab.given("lineitem"), "l_shipdate")


# --- validity ------------------------------------------------------------------------


GROUP_SQL = """CASE WHEN data_type IN ('timestamp_ntz', 'date') THEN 'date'
    WHEN data_type = 'string' AND regexp_matches(lower(column_name), 'phone|mobile|tel|email|address|dien_thoai|dia_chi|url') THEN 'contact'
    WHEN regexp_matches(lower(column_name), '_(id|code|fk)$') OR lower(column_name) = 'id'
      OR regexp_matches(lower(column_name), 'code|key|number|ma_|so_') THEN 'identifier'
    WHEN regexp_matches(lower(column_name), 'loai|tinh_trang|trang_thai|gioi_tinh|nhom_mau|status|state|type|flag|lang') THEN 'category'
    WHEN data_type IN ('bigint', 'int', 'double') THEN 'measure'
    WHEN data_type = 'string' THEN 'text' ELSE 'other' END"""


@check("column_groups", f"""
    {with_intake()}
    SELECT schema_name, table_name, column_name, {GROUP_SQL} AS column_group, row_count
    FROM ({COLUMNS}) JOIN ({COUNTS}) USING (schema_name, table_name)""")
def column_groups(lab: Lab) -> DataFrame:
    group = validity.column_group(F.col("column_name"), F.col("data_type"))
    columns = inventory.column_inventory(lab.registry)
    return columns.select(*TABLE, "column_name", group.alias("column_group")).join(
        inventory.row_counts(lab.registry), TABLE
    )


CUSTOMER_RULES = [
    validity.ValidityRule("email-format", "email", "email"),
    validity.ValidityRule("name-length", "full_name", "length_range", 5, 40),
    validity.ValidityRule("name-pattern", "full_name", "pattern", pattern="^Customer#[0-9]+$"),
    validity.ValidityRule("balance-range", "balance", "number_range", 0, 9000),
    validity.ValidityRule("balance-floor", "balance", "number_range", 0),
    validity.ValidityRule("name-phone", "full_name", "phone"),
    validity.ValidityRule("status-set", "account_status", "enum", allowed=("open", "gold")),
]
ORDER_RULES = [
    validity.ValidityRule("order-date", "ngay_dat", "date_range", date(1995, 1, 1),
                          date(2001, 1, 1)),
]


def _valid_sql(rule: str, table: str, column: str, kind: str, broken: str) -> str:
    return (f"SELECT '{rule}' AS rule_id, '{column}' AS column_name, '{kind}' AS kind, "
            f"count({column}) AS c, count(*) FILTER (WHERE {broken}) AS v FROM {table}")


VALID_ROWS = f"""
    SELECT rule_id, column_name, kind, c AS checked_count, v AS violation_count,
           {share("v", "c")} AS violation_pct FROM ({" UNION ALL ".join([
        _valid_sql("email-format", "customer_record", "email", "email",
                   "NOT regexp_matches(email, '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}$')"),
        _valid_sql("name-length", "customer_record", "full_name", "length_range",
                   "length(full_name) NOT BETWEEN 5 AND 40"),
        _valid_sql("name-pattern", "customer_record", "full_name", "pattern",
                   "NOT regexp_matches(full_name, '^Customer#[0-9]+$')"),
        _valid_sql("balance-range", "customer_record", "balance", "number_range",
                   "balance NOT BETWEEN 0 AND 9000"),
        _valid_sql("balance-floor", "customer_record", "balance", "number_range", "balance < 0"),
        _valid_sql("name-phone", "customer_record", "full_name", "phone",
                   "NOT regexp_matches(full_name, '^\\+?[0-9][0-9 .-]{6,18}[0-9]$')"),
        _valid_sql("status-set", "customer_record", "account_status", "enum",
                   "account_status NOT IN ('open', 'gold')"),
        _valid_sql("order-date", "order_record", "ngay_dat", "date_range",
                   "ngay_dat NOT BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '2001-01-01'"),
    ])})"""


def validity_results(lab: Lab) -> DataFrame:
    return validity.validity_checks(lab.intake("customer_record"), CUSTOMER_RULES).unionByName(
        validity.validity_checks(lab.intake("order_record"), ORDER_RULES)
    )


@check("validity_rules", f"{with_intake('customer_record', 'order_record')} {VALID_ROWS}")
def validity_rules(lab: Lab) -> DataFrame:
    return validity_results(lab)


TIER_OF_RULE = ("CASE WHEN kind = 'email' THEN '1' WHEN kind IN ('number_range', 'enum') THEN '2' "
                "ELSE '3' END")


def tiered_results(lab: Lab) -> DataFrame:
    kind = F.col("kind")
    tier = F.when(kind == "email", "1").when(kind.isin("number_range", "enum"), "2").otherwise("3")
    return validity_results(lab).withColumn("tier", tier)


@check("validity_reported", f"""
    {with_intake('customer_record', 'order_record')}
    SELECT * FROM (SELECT *, {TIER_OF_RULE} AS tier FROM ({VALID_ROWS}))
    WHERE tier = '1' OR violation_pct > 15""")
def validity_reported(lab: Lab) -> DataFrame:
    return validity.reported(tiered_results(lab), 15)


@check("validity_summarised", f"""
    {with_intake('customer_record', 'order_record')}
    SELECT tier, checks, c AS checked_count, v AS violation_count, {share("v", "c")} AS violation_pct
    FROM (SELECT tier, count(*) AS checks, sum(checked_count)::BIGINT AS c,
                 sum(violation_count)::BIGINT AS v
          FROM (SELECT *, {TIER_OF_RULE} AS tier FROM ({VALID_ROWS}))
          WHERE NOT (tier = '1' OR violation_pct > 15) GROUP BY ALL)""")
def validity_summarised(lab: Lab) -> DataFrame:
    return validity.summarised(tiered_results(lab), 15)


# --- integrity -----------------------------------------------------------------------


LINK_ROWS = f"""
    SELECT DISTINCT from_schema || '.' || from_table AS child, to_schema || '.' || to_table AS parent
    FROM ({EDGE_ROWS})"""


# more keys, which make chains of up to ten links
LONG_CHAIN = [
    *key_rows("fk_page", FOREIGN_KEY, "corpus", "documents", ["doc_id"], ("web_log", "pk_pages")),
    *key_rows("fk_event", FOREIGN_KEY, "web_log", "pages", ["page_id"], ("web_log", "pk_events")),
    *key_rows("fk_taken", FOREIGN_KEY, "web_log", "events", ["user_id"],
              ("intake", "pk_order_record")),
    *key_rows("fk_item", FOREIGN_KEY, "intake", "customer_record", ["nation_code"],
              ("intake", "pk_item")),
    *key_rows("fk_part", FOREIGN_KEY, "intake", "item_catalog", ["item_id"], ("sales", "pk_part")),
    *key_rows("fk_maker", FOREIGN_KEY, "sales", "part", ["p_size"], ("sales", "pk_supplier")),
]


@check("fk_chains", f"""
    {with_intake().replace("WITH ", "WITH RECURSIVE ", 1)},
    links AS ({LINK_ROWS} UNION VALUES ('corpus.documents', 'web_log.pages'),
        ('web_log.pages', 'web_log.events'), ('web_log.events', 'intake.order_record'),
        ('intake.customer_record', 'intake.item_catalog'), ('intake.item_catalog', 'sales.part'),
        ('sales.part', 'sales.supplier')),
    chains AS (SELECT [child, parent] AS path, parent,
                      child IN ('sales.nation', 'sales.supplier') AS mandatory FROM links
               UNION ALL SELECT list_append(path, l.parent), l.parent,
                      mandatory AND child IN ('sales.nation', 'sales.supplier')
               FROM chains c JOIN links l ON l.child = c.parent
               WHERE NOT list_contains(path, l.parent))
    SELECT list_aggregate(path, 'string_agg', ' -> ') AS chain,
           CAST(len(path) - 1 AS INTEGER) AS links, mandatory AS all_mandatory,
           n.row_count FROM chains
    JOIN ({COUNTS}) n ON n.schema_name || '.' || n.table_name = path[1]""")
def fk_chains(lab: Lab) -> DataFrame:
    """All chains of declared keys, with the rows of the table they start from."""
    more = constraints_frame(lab.spark, LONG_CHAIN)
    columns = inventory.column_inventory(lab.registry).withColumn(
        "nullable", ~F.col("column_name").isin("n_regionkey", "s_nationkey")
    )
    chains = integrity.foreign_key_chains(
        inventory.foreign_key_edges(lab.constraints.unionByName(more)), columns, lab.scratch("chains")
    )
    counts = inventory.row_counts(lab.registry).select(
        F.concat_ws(".", *TABLE).alias("first"), "row_count"
    )
    first = F.get(F.split("chain", " -> "), F.lit(0)).alias("first")
    return chains.select("*", first).join(counts, "first").drop("first")


# a key that closes a cycle over three tables
CLOSING = key_rows("fk_closing", FOREIGN_KEY, "sales", "region", ["r_regionkey"], ("sales", "pk_customer"))
REACH = f"""
    links AS ({LINK_ROWS} UNION VALUES ('corpus.documents', 'web_log.pages'),
        ('web_log.pages', 'web_log.events'), ('web_log.events', 'intake.order_record'),
        ('intake.customer_record', 'intake.item_catalog'), ('intake.item_catalog', 'sales.part'),
        ('sales.part', 'sales.supplier'), ('sales.region', 'sales.customer')),
    ways AS (SELECT child AS a, parent AS b, 1 AS n, child IN ('sales.nation', 'sales.supplier') AS m FROM links
             UNION SELECT a, parent, n + 1, m AND child IN ('sales.nation', 'sales.supplier')
             FROM ways JOIN links ON child = b WHERE n < 21),
    reach AS (SELECT a, b, CAST(min(n) AS INTEGER) AS links,
                     CAST(min(n) FILTER (WHERE m) AS INTEGER) AS mandatory_links FROM ways GROUP BY ALL)"""


def _reach(lab: Lab) -> DataFrame:
    more = constraints_frame(lab.spark, [*LONG_CHAIN, *CLOSING])
    columns = inventory.column_inventory(lab.registry).withColumn(
        "nullable", ~F.col("column_name").isin("n_regionkey", "s_nationkey")
    )
    edges = inventory.foreign_key_edges(lab.constraints.unionByName(more))
    return integrity.foreign_key_reach(edges, columns, lab.scratch("reach"))


@check("fk_reach", f"""
    {with_intake().replace("WITH ", "WITH RECURSIVE ", 1)}, {REACH}
    SELECT a AS from_table, b AS to_table, links, mandatory_links, f.row_count AS from_rows,
           t.row_count AS to_rows FROM reach
    JOIN ({COUNTS}) f ON f.schema_name || '.' || f.table_name = a
    JOIN ({COUNTS}) t ON t.schema_name || '.' || t.table_name = b""", shown=["mandatory_links"])
def fk_reach(lab: Lab) -> DataFrame:
    """Which tables lead to which along the declared keys, with the rows of both."""
    counts = inventory.row_counts(lab.registry).select(F.concat_ws(".", *TABLE).alias("name"), "row_count")
    found = _reach(lab)
    for side in ("from", "to"):
        named = counts.select(F.col("name").alias(f"{side}_table"), F.col("row_count").alias(f"{side}_rows"))
        found = found.join(named, f"{side}_table")
    return found


@check("fk_cycles", f"""
    {with_intake().replace("WITH ", "WITH RECURSIVE ", 1)}, {REACH}
    SELECT x.a AS table_name, min(x.b) AS cycle, count(*) AS tables, any_value(n.row_count) AS row_count
    FROM reach x JOIN reach y ON x.a = y.b AND x.b = y.a
    JOIN ({COUNTS}) n ON n.schema_name || '.' || n.table_name = x.a GROUP BY x.a""")
def fk_cycles(lab: Lab) -> DataFrame:
    """Tables that lead back to themselves, with their rows."""
    counts = inventory.row_counts(lab.registry).select(F.concat_ws(".", *TABLE).alias("table_name"), "row_count")
    return integrity.foreign_key_cycles(_reach(lab)).join(counts, "table_name")


@check("broken_links", f"""
    WITH n AS (SELECT count(*) AS c, count(*) FILTER (WHERE o_orderkey NOT IN
                   (SELECT l_orderkey FROM lineitem)) AS b FROM orders)
    SELECT c AS checked_count, b AS broken_count, {share("b", "c")} AS broken_pct FROM n""")
def broken_links(lab: Lab) -> DataFrame:
    return integrity.broken_links(
        lab.given("orders"), lab.given("lineitem"), [("o_orderkey", "l_orderkey")]
    )


LINKED = [
    ("corpus", "labels", "corpus", "documents", [("doc_id", "doc_id")]),
    ("sales", "customer", "sales", "orders", [("c_custkey", "o_custkey")]),
    ("sales", "lineitem", "sales", "orders", [("l_orderkey", "o_orderkey")]),
    ("sales", "nation", "sales", "customer", [("n_nationkey", "c_nationkey")]),
    ("sales", "nation", "sales", "supplier", [("n_nationkey", "s_nationkey")]),
    ("sales", "orders", "sales", "lineitem", [("o_orderkey", "l_orderkey")]),
    ("sales", "part", "sales", "lineitem", [("p_partkey", "l_partkey")]),
    ("sales", "supplier", "sales", "lineitem", [("s_suppkey", "l_suppkey")]),
]


def _broken_sql(s: str, a: str, u: str, b: str, pairs: list[tuple[str, str]]) -> str:
    c, d = pairs[0]
    return (f"SELECT '{s}.{a}' AS from_table, '{u}.{b}' AS to_table, '{c} = {d}' AS key, "
            f"count(*) AS c, count(*) FILTER (WHERE {c} NOT IN (SELECT {d} FROM {b})) AS b FROM {a}")


@check("broken_link_checks", f"""
    WITH n AS ({" UNION ALL ".join(_broken_sql(*link) for link in LINKED)})
    SELECT from_table, to_table, key, c AS checked_count, b AS broken_count,
           {share("b", "c")} AS broken_pct FROM n""")
def broken_link_checks(lab: Lab) -> DataFrame:
    """Mandatory next records along the declared keys, both ways, in one scan of each table."""
    return integrity.broken_link_checks(
        lab.registry, [((s, a), (u, b), pairs) for s, a, u, b, pairs in LINKED]
    )


@check("chain_completeness", f"""
    WITH lines AS (SELECT * FROM lineitem WHERE l_returnflag = 'R'),
    o AS (SELECT * FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lines)),
    n AS (SELECT count(*) AS c, count(*) FILTER (WHERE c_custkey IN (SELECT o_custkey FROM o)) AS k
          FROM customer)
    SELECT c AS record_count, k AS complete_count, c - k AS broken_count,
           {share("c - k", "c")} AS broken_pct FROM n""")
def chain_completeness(lab: Lab) -> DataFrame:
    """Customers from whom an order and a returned line of it can be reached."""
    returned = lab.given("lineitem").filter(F.col("l_returnflag") == "R")
    return integrity.chain_completeness(
        lab.given("customer"),
        [integrity.Link(lab.given("orders"), (("c_custkey", "o_custkey"),)),
         integrity.Link(returned, (("o_orderkey", "l_orderkey"),))],
    )


# --- history -------------------------------------------------------------------------


@check("ordered_versions", """
    SELECT user_id, CAST(ts AS VARCHAR) AS ts, event_id, event_type,
           row_number() OVER w AS version, lag(event_type) OVER w AS prev_event_type
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def ordered_versions(lab: Lab) -> DataFrame:
    found = temporal.ordered_versions(
        lab.given("events"), ["user_id"], "ts", ["event_id"], ["event_type"]
    )
    return found.withColumn("ts", F.col("ts").cast("string"))


@check("interval_problems", f"""
    WITH i AS (SELECT o_custkey, o_orderkey, o_orderdate AS s,
                      CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW'
                           THEN o_orderdate - INTERVAL 1 DAY ELSE o_orderdate + INTERVAL 30 DAY END AS e
               FROM orders),
    m AS (SELECT *, max(e) OVER (PARTITION BY o_custkey ORDER BY s, o_orderkey
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM i),
    n AS (SELECT count(*) AS c, count(*) FILTER (WHERE s < before) AS o,
                 count(*) FILTER (WHERE s > e) AS r FROM m)
    SELECT c AS checked_count, o AS overlap_count, r AS reversed_count,
           {share("o", "c")} AS overlap_pct FROM n""")
def interval_problems(lab: Lab) -> DataFrame:
    reversed_one = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW")
    intervals = lab.given("orders").select(
        "o_custkey", "o_orderkey", F.col("o_orderdate").alias("s"),
        F.when(reversed_one, F.col("o_orderdate") - F.expr("INTERVAL 1 DAY"))
        .otherwise(F.col("o_orderdate") + F.expr("INTERVAL 30 DAY")).alias("e"),
    )
    return temporal.interval_problems(intervals, ["o_custkey"], "s", "e", ["o_orderkey"])


PAIRS = """
    SELECT lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS from_status,
           event_type AS to_status FROM events"""


@check("state_transitions", f"""
    SELECT from_status, to_status, count(*) AS transition_count FROM ({PAIRS})
    WHERE from_status IS NOT NULL GROUP BY ALL""")
def state_transitions(lab: Lab) -> DataFrame:
    return temporal.transitions(lab.given("events"), ["user_id"], "ts", ["event_id"], "event_type")


ALLOWED = [("signup", "view"), ("view", "click"), ("click", "purchase"), ("view", "view")]


@check("illegal_transitions", f"""
    SELECT from_status, to_status, count(*) AS transition_count FROM ({PAIRS})
    WHERE from_status IS NOT NULL AND (from_status, to_status) NOT IN (
        ('signup', 'view'), ('view', 'click'), ('click', 'purchase'), ('view', 'view'))
    GROUP BY ALL""")
def illegal_transitions(lab: Lab) -> DataFrame:
    allowed = lab.spark.createDataFrame(ALLOWED, "from_status string, to_status string")
    return temporal.illegal_transitions(state_transitions(lab), allowed)


@check("returns_to_old_state", f"""
    WITH s AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev,
                      row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS nth
               FROM events),
    n AS (SELECT count(*) AS c, count(*) FILTER (WHERE nth > 1) AS r FROM s
          WHERE prev <> event_type)
    SELECT c AS change_count, r AS return_count, {share("r", "c")} AS return_pct FROM n""")
def returns_to_old_state(lab: Lab) -> DataFrame:
    return temporal.returns_to_old_state(
        lab.given("events"), ["user_id"], "ts", ["event_id"], "event_type"
    )


@check("missing_companions", f"""
    WITH p AS (SELECT user_id, CAST(ts AS DATE) AS d FROM events WHERE event_type = 'purchase'),
    v AS (SELECT user_id, CAST(ts AS DATE) AS d FROM events WHERE event_type = 'view'),
    n AS (SELECT count(*) AS c, count(*) FILTER (WHERE (user_id, d) NOT IN (SELECT (user_id, d) FROM v)) AS m
          FROM p)
    SELECT c AS checked_count, m AS missing_count, {share("m", "c")} AS missing_pct FROM n""")
def missing_companions(lab: Lab) -> DataFrame:
    """Purchases without a view by the same user on the same day."""
    dated = lab.given("events").select(
        "user_id", "event_type", F.col("ts").cast("date").alias("d")
    )
    same = [("user_id", "user_id"), ("d", "d")]
    return temporal.missing_companions(
        dated.filter("event_type = 'purchase'"), dated.filter("event_type = 'view'"), same
    )


# --- lineage -------------------------------------------------------------------------


@check("source_columns", f"""
    {with_intake()}
    SELECT schema_name, table_name, column_name, row_count
    FROM ({COLUMNS}) JOIN ({COUNTS}) USING (schema_name, table_name)
    WHERE regexp_matches(lower(column_name), 'created_by|source|data_source|origin|import_batch')""")
def source_columns(lab: Lab) -> DataFrame:
    found = lineage.source_columns(inventory.column_inventory(lab.registry))
    return found.select(*TABLE, "column_name").join(inventory.row_counts(lab.registry), TABLE)


@check("entry_source", """
    SELECT CASE WHEN regexp_matches(lower(url), 'migration|legacy|import') THEN 'migration'
                WHEN regexp_matches(lower(url), 'device|sensor|monitor') THEN 'device'
                WHEN regexp_matches(lower(url), 'api|feed') THEN 'api'
                WHEN regexp_matches(lower(url), 'user|manual|form|//m[.]') THEN 'manual'
                ELSE 'other' END AS entry_source, count(*) AS row_count
    FROM pages GROUP BY ALL""")
def entry_source(lab: Lab) -> DataFrame:
    rules = (("migration", ("migration", "legacy", "import")),
             ("device", ("device", "sensor", "monitor")), ("api", ("api", "feed")),
             ("manual", ("user", "manual", "form", "//m.")))
    kind = lineage.entry_source(F.col("url"), rules)
    return lab.given("pages").groupBy(kind.alias("entry_source")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


@check("quality_by_source", f"""
    WITH d AS (SELECT doc_id, source, CASE WHEN n_chars < 100 THEN NULL WHEN n_chars < 300 THEN 'unknown'
                      ELSE lang END AS lang FROM documents),
    n AS (SELECT source, count(*) AS row_count, count(*) - count(lang) AS e,
                 count(*) FILTER (WHERE lower(trim(lang)) IN ('', 'n/a', '.', '-', '_', 'unknown', 'x')) AS d,
                 count(*) FILTER (WHERE lang NOT IN ('en', 'de', 'fr')) AS i,
                 count(*) FILTER (WHERE doc_id NOT IN (SELECT doc_id FROM labels)) AS o
          FROM d GROUP BY ALL)
    SELECT source, row_count, {share("e", "row_count")} AS null_pct,
           {share("d", "row_count")} AS dirty_pct, {share("i", "row_count")} AS invalid_pct,
           {share("o", "row_count")} AS orphan_pct FROM n""")
def quality_by_source(lab: Lab) -> DataFrame:
    size = F.col("n_chars")
    lang = F.when(size >= 300, F.col("lang")).when(size >= 100, F.lit("unknown"))
    documents = lab.given("documents").select("doc_id", "source", lang.alias("lang"))
    return lineage.quality_by_source(
        documents, F.col("source"), "lang", F.col("lang").isin("en", "de", "fr"),
        lab.given("labels"), [("doc_id", "doc_id")],
    )
