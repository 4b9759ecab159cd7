"""Inventory, profile, growth and snapshot queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqloom.functions import naming
from dqloom.functions.numbers import months_inclusive
from dqloom.functions.text import clean_cell, masked, mask_sample
from dqloom.functions.timewindow import has_window, window_bound
from dqloom.operators import growth, inventory, profile
from dqloom.operators.keyed import union_all
from dqloom.sources import ranges, snapshots
from dqloom.sources.registry import TableRegistry, user_schemas
from verification.consistency import EDGE_ROWS, TIER_ONE_EDGE_ROWS, edges_of, keyed_columns
from verification.fixtures import (
    ALL_TABLES,
    COLUMNS,
    CONSTRAINT_ROWS,
    COUNTS,
    Lab,
    check,
    share,
    with_intake,
)

TABLE = ["schema_name", "table_name"]
TS_NAMES = "creat|insert|updat|modif|chang|timestamp|ngay|thoigian|date|time|version"
PII_COLUMNS = "'full_name', 'email', 'account_number'"


def _types(table: str) -> list[tuple[str, str]]:
    """Column names and oracle types of a table."""
    return {
        "customer_record": [
            ("customer_id", "n"), ("full_name", "s"), ("segment_code", "s"), ("ghi_chu", "s"),
            ("account_status", "s"), ("email", "s"), ("nation_code", "n"), ("balance", "n"),
        ],
        "item_catalog": [("item_id", "n"), ("brand", "s"), ("loai", "s"), ("size_cm", "n"),
                         ("price", "n")],
        "order_record": [("order_id", "n"), ("customer_id", "n"), ("status", "s"),
                         ("total_amount", "n"), ("ngay_dat", "d")],
        "account_archive": [("account_id", "n"), ("account_number", "s"), ("balance", "n")],
        "documents": [("doc_id", "n"), ("text", "s"), ("lang", "s"), ("source", "s"),
                      ("n_chars", "n")],
        "embeddings": [("vec_id", "n"), ("embedding", "a"), ("label", "n")],
        "events": [("event_id", "n"), ("ts", "d"), ("user_id", "n"), ("event_type", "s"),
                   ("value", "n"), ("props", "s")],
        "region": [("r_regionkey", "n"), ("r_name", "s")],
        "nation": [("n_nationkey", "n"), ("n_name", "s"), ("n_regionkey", "n")],
        "customer": [("c_custkey", "n"), ("c_name", "s"), ("c_nationkey", "n"),
            ("c_acctbal", "n"), ("c_mktsegment", "s")],
        "supplier": [("s_suppkey", "n"), ("s_name", "s"), ("s_nationkey", "n"),
            ("s_acctbal", "n")],
        "part": [("p_partkey", "n"), ("p_name", "s"), ("p_brand", "s"), ("p_type", "s"),
            ("p_size", "n"), ("p_retailprice", "n")],
        "orders": [("o_orderkey", "n"), ("o_custkey", "n"), ("o_orderstatus", "s"),
            ("o_totalprice", "n"), ("o_orderdate", "d"), ("o_orderpriority", "s")],
        "lineitem": [("l_orderkey", "n"), ("l_partkey", "n"), ("l_suppkey", "n"),
            ("l_linenumber", "n"), ("l_quantity", "n"), ("l_extendedprice", "n"),
            ("l_discount", "n"), ("l_tax", "n"), ("l_returnflag", "s"), ("l_linestatus", "s"),
            ("l_shipdate", "d")],
        "pages": [("page_id", "n"), ("url", "s"), ("html", "s")],
        "benchmark": [("item_id", "n"), ("text", "s")],
        "labels": [("doc_id", "n"), ("quality", "n"), ("toxic", "n")],
        "conversations": [("conv_id", "n"), ("turn", "n"), ("role", "s"), ("text", "s")],
        "order_line": [("order_id", "n"), ("line_no", "n"), ("item_id", "n"),
            ("start_date", "d"), ("end_date", "d"), ("created_at", "d"), ("return_status", "s"),
            ("amount", "n")],
        "order_copy": [("order_id", "n"), ("customer_id", "n"), ("status", "s")],
        "event_history": [("event_id", "n"), ("user_id", "n"), ("state", "s"), ("event_at", "d"),
            ("value", "n"), ("props", "s")],
    }[table]


PROFILED = ALL_TABLES


def _per_column(template: str, keys=PROFILED, skip: str = "") -> str:
    """Union of a template over columns: ``$s $t $c`` and the type letter ``$k``."""
    return " UNION ALL ".join(
        template.replace("$s", s).replace("$t", t).replace("$c", c)
        for s, t in keys for c, kind in _types(t) if kind not in skip
    )


@check("table_row_count", f"{with_intake()} {COUNTS}")
def table_row_count(lab: Lab) -> DataFrame:
    return inventory.row_counts(lab.registry)


KEY_COUNTS = f"""
    SELECT schema_name, table_name,
           count(DISTINCT constraint_name) FILTER (WHERE constraint_type = 'PRIMARY KEY') AS has_pk,
           count(DISTINCT constraint_name) FILTER (WHERE constraint_type = 'FOREIGN KEY') AS fk_count
    FROM {CONSTRAINT_ROWS} GROUP BY ALL"""
TS_LISTS = f"""
    SELECT schema_name, table_name, count(*) AS column_count,
           coalesce(string_agg(column_name, ', ' ORDER BY column_name) FILTER (WHERE
               data_type IN ('date', 'timestamp_ntz') AND regexp_matches(lower(column_name), '{TS_NAMES}')), '')
               AS ts_columns
    FROM ({COLUMNS}) GROUP BY ALL"""
TABLE_ROWS = f"""
    SELECT n.*, column_count, coalesce(has_pk, 0) AS has_pk, coalesce(fk_count, 0) AS fk_count,
           ts_columns
    FROM ({COUNTS}) n JOIN ({TS_LISTS}) USING (schema_name, table_name)
    LEFT JOIN ({KEY_COUNTS}) USING (schema_name, table_name)"""


@check("table_inventory", f"{with_intake()} {TABLE_ROWS}")
def table_inventory(lab: Lab) -> DataFrame:
    found = inventory.table_inventory(lab.registry, lab.constraints, sizes=False)
    return found.select(*TABLE, "row_count", "column_count", "has_pk", "fk_count", "ts_columns")


@check("table_bytes")
def table_bytes(lab: Lab) -> DataFrame:
    """Bytes on storage; the oracle sees no files."""
    return inventory.file_sizes(lab.registry)


@check("schema_list", f"""
    {with_intake()} SELECT schema_name, sum(row_count)::BIGINT AS row_count FROM ({COUNTS}) GROUP BY ALL""")
def schema_list(lab: Lab) -> DataFrame:
    """User schemas with their rows."""
    known = lab.registry.tables().unionByName(
        lab.spark.createDataFrame(
            [("pg_catalog", "pg_class", ""), ("information_schema", "tables", ""),
             ("pg_temp_3", "t", "")],
            "schema_name string, table_name string, comment string",
        )
    )
    rows = inventory.row_counts(lab.registry).groupBy("schema_name").agg(
        F.sum("row_count").alias("row_count")
    )
    return user_schemas(known).join(rows, "schema_name", "left")


@check("schema_summary", f"""
    {with_intake()}
    SELECT schema_name, count(DISTINCT table_name) AS table_count,
           sum(row_count)::BIGINT AS row_count FROM ({COUNTS}) GROUP BY ALL""")
def schema_summary(lab: Lab) -> DataFrame:
    tables = inventory.table_inventory(lab.registry, lab.constraints)
    rows = tables.groupBy("schema_name").agg(F.sum("row_count").alias("row_count"))
    return inventory.schema_summary(tables).drop("total_bytes").join(rows, "schema_name")


@check("column_inventory", f"""
    {with_intake()},
    keys AS (SELECT schema_name, table_name, column_name,
                    bool_or(constraint_type = 'PRIMARY KEY') AS pk,
                    bool_or(constraint_type = 'FOREIGN KEY') AS fk,
                    bool_or(constraint_type = 'UNIQUE') AS uq
             FROM {CONSTRAINT_ROWS} GROUP BY ALL)
    SELECT c.*, coalesce(pk, FALSE) AS pk, coalesce(fk, FALSE) AS fk, coalesce(uq, FALSE) AS uq,
           row_count
    FROM ({COLUMNS}) c LEFT JOIN keys USING (schema_name, table_name, column_name)
    JOIN ({COUNTS}) USING (schema_name, table_name)""")
def column_inventory(lab: Lab) -> DataFrame:
    columns = keyed_columns(lab).select(
        *TABLE, "column_name", "data_type", "position", "pk", "fk", "uq"
    )
    return columns.join(inventory.row_counts(lab.registry), TABLE)


TYPED = [  # name, full type, default, comment, nullable, expression over customer
    ("client_id", "bigint", None, "number of the client", True, "c_custkey"),
    ("segment", "varchar(40)", None, "market segment", True, "c_mktsegment"),
    ("nation_code", "char(4)", None, "", True, "CAST(c_nationkey AS STRING)"),
    ("balance", "decimal(12,2)", "0.00", "", True, "CAST(c_acctbal AS DECIMAL(12,2))"),
    ("seen", "timestamp_ntz", None, "", True, "CAST(NULL AS TIMESTAMP_NTZ)"),
]
PLAIN = [("copy_id", "bigint", None, "", False, ""), ("tags", "array<string>", None, "", False, ""),
         ("spot", "struct<x:int,y:decimal(9,3)>", None, "", True, "")]


@check("column_details", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{n}' AS column_name, {i} AS position, "
    f"'{'string' if 'char' in kind else kind.split('(')[0] if kind[-1] == ')' else kind}' AS data_type, '{kind}' AS full_type, {str(nullable).upper()} AS nullable, "
    f"coalesce({'NULL' if default is None else repr(default)}, 'none') AS default_text, '{comment}' AS comment, "
    f"(SELECT count(*) FROM customer) AS row_count"
    for t, columns in (("client", TYPED), ("client_copy", PLAIN))
    for i, (n, kind, default, comment, nullable, _) in enumerate(columns, 1)
))
def column_details(lab: Lab) -> DataFrame:
    """Full types, defaults, comments and NULL rules: a catalog table filled from the customers, and a frame."""
    name = lab.scratch("client").rsplit("/", 1)[1].replace("-", "_")
    listed = ", ".join(
        f"{n} {kind}" + (f" DEFAULT {default}" if default else "") + (f" COMMENT '{comment}'" if comment else "")
        for n, kind, default, comment, _, _ in TYPED
    )
    lab.given("customer").createOrReplaceTempView(f"{name}_source")
    lab.spark.sql(f"CREATE TABLE {name} ({listed}) USING parquet LOCATION '{lab.scratch('client')}'")
    lab.spark.sql(f"INSERT INTO {name} SELECT {', '.join(c[-1] for c in TYPED)} FROM {name}_source")
    copy = lab.given("customer").select(
        F.coalesce("c_custkey", F.lit(0).cast("bigint")).alias("copy_id"), F.array(F.lit("a")).alias("tags"),
        F.when(F.col("c_acctbal") > 0, F.struct(F.lit(1).alias("x"), F.lit(1).cast("decimal(9,3)").alias("y"))).alias("spot"),
    )
    registry = TableRegistry(lab.spark).add("shop", "client", lab.spark.table(name)).add("shop", "client_copy", copy)
    found = inventory.column_inventory(registry).join(inventory.row_counts(registry), TABLE)
    return found.select(
        "table_name", "column_name", "position", "data_type", "full_type", "nullable",
        F.coalesce("default", F.lit("none")).alias("default_text"), "comment", "row_count",
    )


@check("key_flags", f"""
    {with_intake()}
    SELECT schema_name, table_name, column_name,
           bool_or(constraint_type = 'PRIMARY KEY') AS pk,
           bool_or(constraint_type = 'FOREIGN KEY') AS fk,
           bool_or(constraint_type = 'UNIQUE') AS uq, any_value(row_count) AS row_count
    FROM {CONSTRAINT_ROWS} JOIN ({COUNTS}) USING (schema_name, table_name) GROUP BY ALL""")
def key_flags(lab: Lab) -> DataFrame:
    """Key columns only, each once although some are in two constraints."""
    flagged = keyed_columns(lab).filter("pk OR fk OR uq")
    return flagged.select(*TABLE, "column_name", "pk", "fk", "uq").join(
        inventory.row_counts(lab.registry), TABLE
    )


@check("column_null_pct", f"""
    {with_intake()}
    SELECT schema_name, table_name, column_name, total_rows, null_count,
           CASE WHEN total_rows > 0 THEN {share("null_count", "total_rows", 1)} END AS null_pct
    FROM ({_per_column("SELECT '$s' AS schema_name, '$t' AS table_name, '$c' AS column_name, "
                       "count(*) AS total_rows, count(*) - count($c) AS null_count FROM $t")})""")
def column_null_pct(lab: Lab) -> DataFrame:
    return union_all([profile.null_share(lab.registry.table(s, t), s, t) for s, t in PROFILED])


DISTINCT = _per_column(
    "SELECT '$s' AS schema_name, '$t' AS table_name, '$c' AS column_name, "
    "count(DISTINCT $c) AS distinct_count FROM $t"
)


@check("column_distinct", f"{with_intake()} {DISTINCT}")
def column_distinct(lab: Lab) -> DataFrame:
    return union_all([profile.distinct_counts(lab.registry.table(s, t), s, t) for s, t in PROFILED])


@check("approx_cardinality", f"""
    {with_intake()} SELECT schema_name, table_name, column_name, TRUE AS close FROM ({DISTINCT})""")
def approx_cardinality(lab: Lab) -> DataFrame:
    """Sketched distinct counts lie within 10 % (or 2) of the exact ones."""
    by = [*TABLE, "column_name"]
    frames = []
    for s, t in PROFILED:
        frame = lab.registry.table(s, t)
        sketched = profile.approximate_distinct(frame, s, t).withColumnRenamed(
            "distinct_count", "sketched"
        )
        frames.append(sketched.join(profile.distinct_counts(frame, s, t), by))
    off = F.abs(F.col("sketched") - F.col("distinct_count"))
    close = (off <= F.col("distinct_count") * 0.1) | (off <= 2)
    return union_all(frames).select(*by, close.alias("close"))


def _all_columns(template: str, first: list[tuple[str, str]], array: str) -> str:
    """A template over the tables named first, and over all others with what they hold beyond those.

    There zeros have no sign, and arrays, which have no order, have a template of their own.
    """
    rest = [key for key in ALL_TABLES if key not in first]
    unsigned = template.replace("'$c'", "'@'").replace("$c", "($c + 0)").replace("'@'", "'$c'")
    return " UNION ALL ".join([
        _per_column(template, first), _per_column(unsigned, rest, skip="sda"),
        _per_column(template, rest, skip="na"), _per_column(array, rest, skip="nsd"),
    ])


FEW = [("intake", "customer_record", "account_status"), ("intake", "order_record", "status")]


EXACT = (
    "SELECT '$s' AS schema_name, '$t' AS table_name, '$c' AS column_name, "
    "count(*) AS total_rows, count(*) - count($c) AS null_count, "
    "coalesce(CAST(min($c) AS VARCHAR), '') AS col_min, coalesce(CAST(max($c) AS VARCHAR), '') AS col_max FROM $t"
)
EXACT_ARRAY = (
    "SELECT '$s' AS schema_name, '$t' AS table_name, '$c' AS column_name, "
    "count(*) AS total_rows, count(*) - count($c) AS null_count, '' AS col_min, '' AS col_max FROM $t"
)


@check("approx_profile", f"""
    {with_intake()},
    exact AS ({_all_columns(EXACT, [("intake", "customer_record"), ("intake", "order_record")], EXACT_ARRAY)}),
    common AS ({" UNION ALL ".join(
        f"SELECT '{s}' AS schema_name, '{t}' AS table_name, '{c}' AS column_name, "
        f"string_agg(v, ' | ' ORDER BY n DESC, v) AS common_values FROM "
        f"(SELECT {c} AS v, count(*) AS n FROM {t} WHERE {c} IS NOT NULL GROUP BY ALL)"
        for s, t, c in FEW)})
    SELECT exact.*, coalesce(common_values, '') AS common_values, TRUE AS close
    FROM exact LEFT JOIN common USING (schema_name, table_name, column_name)""")
def approx_profile(lab: Lab) -> DataFrame:
    """The one-pass profile: exact parts compared, sketched counts within 10 % (or 2)."""
    by = [*TABLE, "column_name"]
    frames = []
    for s, t in ALL_TABLES:
        frame = lab.registry.table(s, t)
        exact = profile.distinct_counts(frame, s, t).withColumnRenamed("distinct_count", "exact")
        frames.append(profile.approximate_profile(frame, s, t).join(exact, by))
    off = F.abs(F.col("cardinality") - F.col("exact"))
    few = F.concat_ws(".", *by).isin([".".join(column) for column in FEW])
    return union_all(frames).select(
        *by, "total_rows", "null_count", "col_min", "col_max",
        F.when(few, F.col("sample")).otherwise(F.lit("")).alias("common_values"),
        ((off <= F.col("exact") * 0.1) | (off <= 2)).alias("close"),
    )


BOUNDED = [("intake", "customer_record"), ("intake", "order_record"), ("corpus", "documents"),
           ("intake", "account_archive"), ("web_log", "events")]
BOUNDS = (
    "SELECT '$s' AS schema_name, '$t' AS table_name, '$c' AS column_name, "
    "CAST(min($c) AS VARCHAR) AS col_min, CAST(max($c) AS VARCHAR) AS col_max FROM $t"
)
NO_BOUNDS = (
    "SELECT '$s' AS schema_name, '$t' AS table_name, '$c' AS column_name, "
    "CAST(NULL AS VARCHAR) AS col_min, CAST(NULL AS VARCHAR) AS col_max"
)


@check("column_min_max", f"""
    {with_intake()}
    {_all_columns(BOUNDS, BOUNDED, NO_BOUNDS)}""")
def column_min_max(lab: Lab) -> DataFrame:
    found = union_all([profile.column_counts(lab.registry.table(s, t), s, t) for s, t in ALL_TABLES])
    return found.select(*TABLE, "column_name", "col_min", "col_max")


TOP = """
    SELECT '$s' AS schema_name, '$t' AS table_name, '$c' AS column_name, rank,
           CAST(v AS VARCHAR) AS value, n
    FROM (SELECT v, n, row_number() OVER (ORDER BY n DESC, v)::INTEGER AS rank
          FROM (SELECT $c AS v, count(*) AS n FROM $t WHERE $c IS NOT NULL GROUP BY ALL))
    WHERE rank <= 5"""


@check("top_values", f"{with_intake()} {_per_column(TOP, skip='a')}")
def top_values(lab: Lab) -> DataFrame:
    return union_all([profile.top_values(lab.registry.table(s, t), s, t) for s, t in PROFILED])


MASK_SQL = (
    "list_aggregate(list_transform(string_split({0}, ' | '), lambda p: "
    "CASE WHEN length(trim(p)) > 2 THEN left(trim(p), 2) || '***' ELSE '***' END), "
    "'string_agg', ' | ')"
)
PROFILE_ONE = """
    SELECT '$s' AS schema_name, '$t' AS table_name, '$c' AS column_name,
        (SELECT count(*) FROM $t) AS total_rows,
        (SELECT count(DISTINCT $c) FROM $t) AS cardinality,
        (SELECT count(*) - count($c) FROM $t) AS null_count,
        (SELECT CAST(min($c) AS VARCHAR) FROM $t) AS lo,
        (SELECT CAST(max($c) AS VARCHAR) FROM $t) AS hi,
        (SELECT string_agg(CAST(v AS VARCHAR), ' | ' ORDER BY n DESC, v) FROM
            (SELECT $c AS v, count(*) AS n FROM $t WHERE $c IS NOT NULL GROUP BY ALL
             HAVING count(*) > 1 ORDER BY n DESC, v LIMIT 5)) AS listed,
        (SELECT string_agg(printf('%.1f', CAST(n AS DOUBLE) / CAST((SELECT count(*) FROM $t) AS DOUBLE) * 100) || '%',
                           ' | ' ORDER BY n DESC, v) FROM
            (SELECT $c AS v, count(*) AS n FROM $t WHERE $c IS NOT NULL GROUP BY ALL
             HAVING count(*) > 1 ORDER BY n DESC, v LIMIT 5)) AS freqs"""
PROFILE_ARRAY = """
    SELECT '$s', '$t', '$c', count(*), count(DISTINCT $c), count(*) - count($c), NULL, NULL, NULL, NULL FROM $t"""
STATS = [("intake", "customer_record"), ("intake", "item_catalog"), ("intake", "order_record")]


def _profile_sql(keys=()) -> str:
    """Column reports of the tables, or of all that have rows."""
    sample = "coalesce(nullif(listed, ''), lo, '')"
    return f"""
        SELECT schema_name, table_name, column_name, total_rows, cardinality,
               printf('%.1f', CAST(cardinality AS DOUBLE) / CAST(total_rows AS DOUBLE) * 100) || '%' AS distinct_pct,
               null_count, {share("null_count", "total_rows", 1)} AS null_pct,
               coalesce(lo, '') AS col_min, coalesce(hi, '') AS col_max,
               coalesce(freqs, '') AS most_common_freqs,
               CASE WHEN column_name IN ({PII_COLUMNS}) THEN {MASK_SQL.format(sample)}
                    ELSE {sample} END AS sample
        FROM ({_per_column(PROFILE_ONE, keys) if keys else _all_columns(PROFILE_ONE, STATS, PROFILE_ARRAY)})
        {"" if keys else "WHERE total_rows > 0"}"""


@check("column_profile", f"{with_intake()} {_profile_sql()}")
def column_profile(lab: Lab) -> DataFrame:
    found = union_all([profile.column_profile(lab.registry.table(s, t), s, t) for s, t in ALL_TABLES])
    return found.drop("pii_phi")


@check("stats_lookup", f"""
    {with_intake()} {_profile_sql([("intake", "item_catalog")])}
    UNION ALL
    SELECT schema_name, table_name, column_name, 0, 0, '', 0, 0.0, '', '', '',
           CASE WHEN row_count = 0 THEN 'EMPTY_TABLE' ELSE 'NOT_PROFILED' END
    FROM ({COLUMNS}) JOIN ({COUNTS}) USING (schema_name, table_name)
    WHERE table_name IN ('account_archive', 'events')""")
def stats_lookup(lab: Lab) -> DataFrame:
    """One table with statistics, an empty one, and one that was not profiled."""
    keys = [("intake", "item_catalog"), ("intake", "account_archive"), ("web_log", "events")]
    statistics = profile.column_profile(lab.intake("item_catalog"), "intake", "item_catalog")
    return profile.stats_lookup(
        inventory.column_inventory(lab.registry, keys), statistics,
        inventory.row_counts(lab.registry, keys),
    )


# --- growth --------------------------------------------------------------------------


def _growth_sql(schema: str, table: str, column: str, since: str = "", until: str = "") -> str:
    if since:
        rows = f"count(*) FILTER (WHERE {column} BETWEEN TIMESTAMP '{since}' AND TIMESTAMP '{until}')"
        months = (
            f"((year(TIMESTAMP '{until}') - year(TIMESTAMP '{since}')) * 12 + "
            f"month(TIMESTAMP '{until}') - month(TIMESTAMP '{since}') + 1)::DOUBLE"
        )
        note, start = f"'WINDOW({column})'", f"'{since}'"
    else:
        rows = f"count({column})"
        months = f"(epoch_us(max({column})) - epoch_us(min({column}))) / 1000000.0::DOUBLE / 2592000.0::DOUBLE"
        note, start = f"'MIN_TO_MAX({column})'", f"CAST(min({column}) AS VARCHAR)"
    return f"""
        SELECT '{schema}' AS schema_name, '{table}' AS table_name,
               CAST(round_even({rows} / ({months}), 0) AS BIGINT) AS growth, {note} AS note,
               '{column}, start_date: ' || {start} AS time_info FROM {table}"""


EMPTY_GROWTH = "SELECT 'intake', 'account_archive', CAST(NULL AS BIGINT), 'NO_TIMESTAMP', ''"
GROWING = [("sales", "orders"), ("sales", "lineitem"), ("intake", "order_record"),
           ("intake", "order_line"), ("intake", "account_archive")]


@check("growth_min_max", f"""
    {with_intake()}
    {_growth_sql("sales", "orders", "o_orderdate")} UNION ALL
    {_growth_sql("sales", "lineitem", "l_shipdate")} UNION ALL
    {_growth_sql("intake", "order_record", "ngay_dat")} UNION ALL
    {_growth_sql("intake", "order_line", "created_at")} UNION ALL {EMPTY_GROWTH}""", shown=["growth"])
def growth_min_max(lab: Lab) -> DataFrame:
    return growth.growth_rates(lab.registry, GROWING)


SINCE, UNTIL = "1996-01-01 00:00:00", "1996-12-31 23:59:59"


@check("growth_window", f"""
    {with_intake()}
    {_growth_sql("sales", "orders", "o_orderdate", SINCE, UNTIL)} UNION ALL
    {_growth_sql("sales", "lineitem", "l_shipdate", SINCE, UNTIL)} UNION ALL
    {_growth_sql("intake", "order_record", "ngay_dat", SINCE, UNTIL)} UNION ALL
    {_growth_sql("intake", "order_line", "created_at", SINCE, UNTIL)} UNION ALL {EMPTY_GROWTH}""", shown=["growth"])
def growth_window(lab: Lab) -> DataFrame:
    return growth.growth_rates(lab.registry, GROWING, "1996-01-01", "1996-12-31")


SPARSE_ORDERS = """
    SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS created_at,
           o_orderdate AS modified_date,
           CASE WHEN o_orderstatus = 'P' THEN o_orderdate END AS changed_at,
           CASE WHEN o_totalprice < 0 THEN o_orderdate END AS version_time FROM {orders}"""


@check("best_timestamp_column", """
    SELECT 'sales' AS schema_name, 'sparse_orders' AS table_name, 'modified_date' AS best_column,
           count(o_orderdate) AS value_count FROM orders
    UNION ALL SELECT 'sales', 'sparse_orders_2',
           CASE WHEN count(*) FILTER (WHERE o_orderstatus <> 'P') >=
                     count(*) FILTER (WHERE o_orderstatus = 'P') THEN 'created_at' ELSE 'changed_at' END,
           greatest(count(*) FILTER (WHERE o_orderstatus <> 'P'),
                    count(*) FILTER (WHERE o_orderstatus = 'P')) FROM orders""")
def best_timestamp_column(lab: Lab) -> DataFrame:
    frame = lab.sql(SPARSE_ORDERS)
    first = growth.best_timestamp_column(frame, "sales", "sparse_orders")
    second = growth.best_timestamp_column(
        frame, "sales", "sparse_orders_2", ["changed_at", "created_at", "version_time"]
    )
    return first.unionByName(second)


@check("growth_notes", f"""
    SELECT 'sales' AS schema_name, 'never' AS table_name, CAST(NULL AS BIGINT) AS growth,
           'ALL_NULL(version_time)' AS note, 'version_time, start_date: ' AS time_info,
           count(*) AS row_count FROM orders
    UNION ALL SELECT 'sales', 'one_day', NULL, 'MIN_EQUALS_MAX(load_date)',
           'load_date, start_date: ' || min(o_orderdate), count(*) FROM orders
    UNION ALL SELECT 'sales', 'days', CAST(round_even(count(*) /
           (datediff('day', min(o_orderdate), max(o_orderdate)) / 30.44::DOUBLE), 0) AS BIGINT),
           'MIN_TO_MAX(day_date)', 'day_date, start_date: ' || CAST(min(o_orderdate) AS DATE),
           count(*) FROM orders
    UNION ALL SELECT 'sales', 'burst', NULL, 'SPAN_TOO_SHORT',
           'burst_time, start_date: ' || (SELECT min(o_orderdate) FROM orders), count(*) FROM orders
    UNION ALL SELECT 'sales', 'none', NULL, 'EMPTY_TABLE', '', 0""", shown=["growth"])
def growth_notes(lab: Lab) -> DataFrame:
    """The cases without a rate, and a plain date column, on the whole orders table."""
    orders = lab.given("orders")
    first_day = orders.agg(F.min("o_orderdate")).scalar()
    cases = {
        "never": lab.sql(SPARSE_ORDERS).select("version_time"),
        "one_day": orders.select(first_day.alias("load_date")),
        "days": orders.select(F.col("o_orderdate").cast("date").alias("day_date")),
        "burst": orders.select(
            F.when(F.col("o_orderstatus") == "P", first_day)
            .otherwise(first_day + F.expr("INTERVAL 1 HOUR")).alias("burst_time")
        ),
        "none": orders.filter(F.col("o_totalprice") < 0).select("o_orderdate"),
    }
    return union_all([
        growth.growth_rate(frame, "sales", name).withColumn(
            "row_count", frame.agg(F.count(F.lit(1))).scalar()
        )
        for name, frame in cases.items()
    ])


@check("timestamp_columns", f"""
    {with_intake()}
    SELECT schema_name, table_name, ts_columns, row_count
    FROM ({TS_LISTS}) JOIN ({COUNTS}) USING (schema_name, table_name)""")
def timestamp_columns(lab: Lab) -> DataFrame:
    lists = inventory.column_inventory(lab.registry).groupBy(*TABLE).agg(
        inventory.timestamp_list().alias("ts_columns")
    )
    return lists.join(inventory.row_counts(lab.registry), TABLE)


WINDOWS = [("1996-01-01", "1996-12-31"), ("1996-01-01 06:00:00", "1996-01-01"),
           ("1997-01-01", "1996-01-01"), ("1996-01-01", ""), ("soon", "1996-01-01"),
           ("1996-05-05", "1996-05-05 00:00:00")]


@check("window_bounds", """
    WITH windows AS (SELECT * FROM (VALUES
        (1, TIMESTAMP '1996-01-01', TIMESTAMP '1996-12-31 23:59:59'),
        (2, TIMESTAMP '1996-01-01 06:00:00', TIMESTAMP '1996-01-01 23:59:59'),
        (3, NULL, NULL), (4, NULL, NULL), (5, NULL, NULL), (6, NULL, NULL)) v(id, lo, hi))
    SELECT id, lo IS NOT NULL AS has_window, CAST(lo AS VARCHAR) AS lower_bound,
           CAST(hi AS VARCHAR) AS upper_bound,
           CAST((year(hi) - year(lo)) * 12 + month(hi) - month(lo) + 1 AS INTEGER) AS months,
           (SELECT count(*) FROM orders WHERE o_orderdate BETWEEN lo AND hi) AS rows_inside
    FROM windows""", shown=["months"])
def window_bounds(lab: Lab) -> DataFrame:
    """Texts of a window as bounds, and the orders inside each window."""
    windows = lab.spark.createDataFrame(
        [(i, s, e) for i, (s, e) in enumerate(WINDOWS, 1)], "id int, s string, e string"
    ).select("id", window_bound(F.col("s")).alias("lo"), window_bound(F.col("e"), True).alias("hi"))
    usable = F.coalesce(has_window(F.col("lo"), F.col("hi")), F.lit(False))
    windows = windows.select(
        "id", F.when(usable, F.col("lo")).alias("lo"), F.when(usable, F.col("hi")).alias("hi")
    )
    # one conditional count per window: the windows are literals, the orders are read once
    per_window = [
        F.count_if(F.col("o_orderdate").between(
            window_bound(F.lit(s)), window_bound(F.lit(e), True)
        )).alias(f"w{i}")
        for i, (s, e) in enumerate(WINDOWS, 1)
    ]
    counted = lab.given("orders").agg(*per_window).select(
        F.inline(F.array(*[
            F.struct(F.lit(i).alias("id"), F.col(f"w{i}").alias("n"))
            for i in range(1, len(WINDOWS) + 1)
        ]))
    )
    return windows.join(counted, "id").select(
        "id",
        F.col("lo").isNotNull().alias("has_window"),
        F.col("lo").cast("string").alias("lower_bound"),
        F.col("hi").cast("string").alias("upper_bound"),
        months_inclusive(F.col("lo"), F.col("hi")).alias("months"),
        F.when(F.col("lo").isNotNull(), F.col("n")).otherwise(F.lit(0)).alias("rows_inside"),
    )


@check("calendar_months", """
    SELECT l_orderkey, count(*) AS lines, max(CAST((year(l_shipdate) - year(o_orderdate)) * 12
           + month(l_shipdate) - month(o_orderdate) + 1 AS INTEGER)) AS months
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL""")
def calendar_months(lab: Lab) -> DataFrame:
    joined = lab.given("lineitem").join(
        lab.given("orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    months = months_inclusive(F.col("o_orderdate"), F.col("l_shipdate"))
    return joined.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("lines"), F.max(months).alias("months")
    )


# --- cells ---------------------------------------------------------------------------


CLEAN_SQL = ("left(regexp_replace(regexp_replace({0}, '[\\x00-\\x08\\x0b-\\x0c\\x0e-\\x1f\\x7f-\\x9f]', '', 'g'), "
             "'\\r\\n|\\r|\\n', ' ', 'g'), 500)")


@check("clean_text", f"""
    SELECT 'documents' AS kind, doc_id AS id, {CLEAN_SQL.format("chr(1) || text || chr(127)")} AS cell
    FROM documents
    UNION ALL SELECT 'pages', page_id, {CLEAN_SQL.format("html")} FROM pages""")
def clean_text(lab: Lab) -> DataFrame:
    """Report cells; the cut at 500 characters is what the cell cleaner is for."""
    noisy = F.concat(F.char(F.lit(1)), F.col("text"), F.char(F.lit(127)))
    documents = lab.given("documents").select(
        F.lit("documents").alias("kind"), F.col("doc_id").alias("id"),
        clean_cell(noisy).alias("cell"),
    )
    pages = lab.given("pages").select(
        F.lit("pages").alias("kind"), F.col("page_id").alias("id"),
        clean_cell(F.col("html")).alias("cell"),
    )
    return documents.unionByName(pages)


@check("mask_values", f"""
    SELECT c_custkey, CASE WHEN length(c_name) > 2 THEN left(c_name, 2) || '***' ELSE '***' END AS name,
           {MASK_SQL.format("c_name || ' | ' || c_nationkey || ' | ' || c_mktsegment")} AS sample
    FROM customer""")
def mask_values(lab: Lab) -> DataFrame:
    sample = F.concat_ws(" | ", "c_name", F.col("c_nationkey").cast("string"), "c_mktsegment")
    return lab.given("customer").select(
        "c_custkey", masked(F.col("c_name")).alias("name"), mask_sample(sample).alias("sample")
    )


# --- names ---------------------------------------------------------------------------


@check("pii_columns", f"""
    {with_intake()}
    SELECT schema_name, table_name, column_name, row_count FROM ({COLUMNS})
    JOIN ({COUNTS}) USING (schema_name, table_name)
    WHERE column_name IN ({PII_COLUMNS}) OR (table_name = 'customer' AND column_name = 'c_name')
      """)
def pii_columns(lab: Lab) -> DataFrame:
    personal = naming.is_personal(
        F.col("schema_name"), F.col("table_name"), F.col("column_name"),
        extra=["sales.customer.c_name"],
    )
    found = inventory.column_inventory(lab.registry).filter(personal)
    return found.select(*TABLE, "column_name").join(inventory.row_counts(lab.registry), TABLE)


# labels of the tables given here; first match wins
TAXONOMY = (
    ("geography", ("region", "nation")),
    ("party", ("customer", "supplier")),
    ("trade", ("order", "lineitem", "part", "item_")),
    ("stream", ("event",)),
    ("training text", ("document", "page", "benchmark", "label", "conversation")),
)
TAXONOMY_SQL = """CASE
    WHEN regexp_matches(table_name, 'region|nation') THEN 'geography'
    WHEN regexp_matches(table_name, 'customer|supplier') THEN 'party'
    WHEN regexp_matches(table_name, 'order|lineitem|part|item_') THEN 'trade'
    WHEN regexp_matches(table_name, 'event') THEN 'stream'
    WHEN regexp_matches(table_name, 'document|page|benchmark|label|conversation') THEN 'training text'
    ELSE 'system' END"""


@check("table_taxonomy", f"""
    {with_intake()} SELECT schema_name, table_name, row_count, {TAXONOMY_SQL} AS label FROM ({COUNTS})""")
def table_taxonomy(lab: Lab) -> DataFrame:
    return inventory.row_counts(lab.registry).withColumn(
        "label", naming.table_label(F.col("table_name"), TAXONOMY)
    )


@check("schema_purpose", f"""
    {with_intake()}
    SELECT schema_name, CASE WHEN schema_name = 'web_log' THEN 'audit' ELSE 'production' END AS purpose,
           sum(row_count)::BIGINT AS row_count FROM ({COUNTS}) GROUP BY ALL""")
def schema_purpose(lab: Lab) -> DataFrame:
    """``web_log`` is "audit": that purpose holds the keyword "log" and is tried first."""
    rows = inventory.row_counts(lab.registry).groupBy("schema_name").agg(
        F.sum("row_count").alias("row_count")
    )
    return rows.withColumn("purpose", naming.schema_purpose(F.col("schema_name")))


@check("fk_edges", f"""
    {with_intake()}
    SELECT e.*, row_count FROM ({EDGE_ROWS}) e JOIN ({COUNTS}) c
      ON c.schema_name = from_schema AND c.table_name = from_table""")
def fk_edges(lab: Lab) -> DataFrame:
    return _with_child_rows(lab, inventory.foreign_key_edges(lab.constraints))


@check("tier1_edges", f"""
    {with_intake()}
    SELECT e.*, row_count FROM ({TIER_ONE_EDGE_ROWS}) e JOIN ({COUNTS}) c
      ON c.schema_name = from_schema AND c.table_name = from_table""")
def tier1_edges(lab: Lab) -> DataFrame:
    return _with_child_rows(lab, edges_of(lab))


def _with_child_rows(lab: Lab, edges: DataFrame) -> DataFrame:
    """Add the number of child rows an edge applies to."""
    counts = inventory.row_counts(lab.registry).select(
        F.col("schema_name").alias("from_schema"), F.col("table_name").alias("from_table"),
        "row_count",
    )
    return edges.join(counts, ["from_schema", "from_table"])


IMPLICIT_ROWS = f"""
    SELECT schema_name, table_name, column_name, data_type,
           regexp_replace(column_name, '_(id|code|fk)$', '', 'i') AS likely_table
    FROM ({COLUMNS}) c
    WHERE regexp_matches(column_name, '_(id|code|fk)$', 'i')
      AND (schema_name, table_name, column_name) NOT IN (
          SELECT (schema_name, table_name, column_name) FROM {CONSTRAINT_ROWS}
          WHERE constraint_type IN ('PRIMARY KEY', 'FOREIGN KEY'))"""


@check("implicit_fk", f"""
    {with_intake()} SELECT i.*, row_count FROM ({IMPLICIT_ROWS}) i
    JOIN ({COUNTS}) USING (schema_name, table_name)""")
def implicit_fk(lab: Lab) -> DataFrame:
    found = inventory.implicit_foreign_keys(
        inventory.column_inventory(lab.registry), lab.constraints
    )
    return found.join(inventory.row_counts(lab.registry), TABLE)


TOKENS = ' "Orders", intake.order_copy, Sales.LineItem, nowhere, region.orders '


@check("table_scope_filter", f"""
    {with_intake()},
    kept AS (SELECT * FROM ({COUNTS}) WHERE table_name IN ('orders', 'order_copy', 'lineitem'))
    SELECT 'tables' AS kind, schema_name || '.' || table_name AS item, row_count AS n FROM kept
    UNION ALL SELECT 'schemas', schema_name, count(*) FROM kept GROUP BY ALL
    UNION ALL SELECT 'columns', table_name, count(*) FROM ({COLUMNS})
              WHERE table_name IN ('orders', 'order_copy', 'lineitem') GROUP BY ALL
    UNION ALL SELECT 'edges', constraint_name, 1 FROM ({EDGE_ROWS})
              WHERE from_table IN ('orders', 'order_copy', 'lineitem')
    UNION ALL SELECT 'implicit', table_name || '.' || column_name, 1 FROM ({IMPLICIT_ROWS})
              WHERE table_name IN ('orders', 'order_copy', 'lineitem')
    UNION ALL SELECT 'unmatched', t, 1 FROM (VALUES ('nowhere'), ('region.orders')) v(t)""")
def table_scope_filter(lab: Lab) -> DataFrame:
    tokens = inventory.parse_table_tokens(TOKENS)
    tables = lab.registry.tables()
    columns = inventory.column_inventory(lab.registry)
    report = inventory.scope_report(
        tokens, tables, columns,
        inventory.implicit_foreign_keys(columns, lab.constraints),
        inventory.foreign_key_edges(lab.constraints),
    )
    inventory.require_match(report, tokens)

    def items(kind: str, frame: DataFrame, item, n) -> DataFrame:
        return frame.select(F.lit(kind).alias("kind"), item.alias("item"),
                            n.cast("bigint").alias("n"))

    counted = report["tables"].join(inventory.row_counts(lab.registry), TABLE)
    per_table = report["columns"].groupBy("table_name").agg(F.count(F.lit(1)).alias("n"))
    return union_all([
        items("tables", counted, F.concat_ws(".", *TABLE), F.col("row_count")),
        items("schemas", report["schemas"], F.col("schema_name"), F.col("table_count")),
        items("columns", per_table, F.col("table_name"), F.col("n")),
        items("edges", report["edges"], F.col("constraint_name"), F.lit(1)),
        items("implicit", report["implicit"], F.concat_ws(".", "table_name", "column_name"),
              F.lit(1)),
        items("unmatched", inventory.unmatched_tokens(tables, tokens), F.col("token"), F.lit(1)),
    ])


SUMMARY_ROWS = f"""
    SELECT 'schemas' AS item, count(DISTINCT schema_name) AS count FROM ({COUNTS})
    UNION ALL SELECT 'tables', count(*) FROM ({COUNTS})
    UNION ALL SELECT 'columns', count(*) FROM ({COLUMNS})
    UNION ALL SELECT 'foreign_keys', count(*) FROM ({EDGE_ROWS})
    UNION ALL SELECT 'implicit_foreign_keys', count(*) FROM ({IMPLICIT_ROWS})
    UNION ALL SELECT 'pii_columns', count(*) FROM ({COLUMNS}) WHERE column_name IN ({PII_COLUMNS})"""


@check("run_summary", f"""
    {with_intake()} {SUMMARY_ROWS}
    UNION ALL SELECT 'rows', sum(row_count)::BIGINT FROM ({COUNTS})""")
def run_summary(lab: Lab) -> DataFrame:
    columns = inventory.column_inventory(lab.registry)
    summary = inventory.run_summary(
        lab.registry.tables(), columns, inventory.foreign_key_edges(lab.constraints),
        inventory.implicit_foreign_keys(columns, lab.constraints),
    )
    rows = inventory.row_counts(lab.registry).agg(F.sum("row_count").alias("count"))
    return summary.unionByName(rows.select(F.lit("rows").alias("item"), "count"))


# --- snapshots -----------------------------------------------------------------------


@check("snapshot_freshness", """
    SELECT 'events' AS schema_name, event_type AS table_name,
           CAST(greatest(m, a) AS VARCHAR) AS last_analyze,
           (epoch_us(TIMESTAMP '2024-01-31') - epoch_us(greatest(m, a))) / 86400000000.0::DOUBLE AS age_days,
           greatest(m, a) IS NULL OR (epoch_us(TIMESTAMP '2024-01-31')
               - epoch_us(greatest(m, a))) / 86400000000.0::DOUBLE > 5 AS needs_analyze
    FROM (SELECT event_type, max(ts) FILTER (WHERE event_type <> 'click' AND value < 30) AS m,
                 min(ts) FILTER (WHERE event_type IN ('view', 'error')) AS a
          FROM events GROUP BY ALL)""")
def snapshot_freshness(lab: Lab) -> DataFrame:
    """The event types stand for tables, their event times for analyse times."""
    kind = F.col("event_type")
    statistics = lab.given("events").groupBy(kind.alias("table_name")).agg(
        F.max(F.when((kind != "click") & (F.col("value") < 30), F.col("ts"))).alias("last_manual"),
        F.min(F.when(kind.isin("view", "error"), F.col("ts"))).alias("last_auto"),
    ).withColumn("schema_name", F.lit("events"))
    now = F.lit("2024-01-31").cast("timestamp_ntz")
    found = snapshots.freshness(statistics, now)
    return found.withColumn("last_analyze", F.col("last_analyze").cast("string"))


@check("snapshot_reconcile", """
    WITH old AS (SELECT o_custkey AS k, count(*) AS n, max(o_totalprice) AS top FROM orders
                 WHERE o_orderstatus <> 'P' GROUP BY ALL),
    new AS (SELECT o_custkey AS k, count(*) AS n, max(o_totalprice) AS top FROM orders
            WHERE o_orderstatus <> 'O' GROUP BY ALL)
    SELECT coalesce(old.k, new.k) AS k, coalesce(new.n, old.n) AS n, coalesce(new.top, old.top) AS top,
           CASE WHEN old.k IS NULL THEN 'NEW' WHEN new.k IS NULL THEN 'ABSENT'
                WHEN old.n = new.n AND old.top = new.top THEN 'SAME' ELSE 'CHANGED' END AS change
    FROM old FULL JOIN new ON old.k = new.k""")
def snapshot_reconcile(lab: Lab) -> DataFrame:
    """Two states of a summary of the orders, reconciled."""
    def state(without: str) -> DataFrame:
        kept = lab.given("orders").filter(F.col("o_orderstatus") != without)
        return kept.groupBy(F.col("o_custkey").alias("k")).agg(
            F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("top")
        )

    return snapshots.reconcile(state("P"), state("O"), ["k"])


# --- key ranges ------------------------------------------------------------------------


SPLIT = [("sales", "orders", "o_orderkey"), ("sales", "lineitem", "l_orderkey"), ("sales", "lineitem", "l_shipdate"),
         ("sales", "customer", "c_acctbal"), ("web_log", "events", "user_id"), ("web_log", "events", "ts"),
         ("intake", "order_record", "customer_id"), ("intake", "account_archive", "account_id")]
RANGES = 16


@check("key_ranges", f"""
    {with_intake()}
    {" UNION ALL ".join(
        f"SELECT '{s}' AS schema_name, '{t}' AS table_name, '{c}' AS column_name, count(*) AS row_count, "
        f"count(*) - count({c}) AS null_keys, count(*) AS in_one_range, TRUE AS even FROM {t}"
        for s, t, c in SPLIT)}""")
def key_ranges(lab: Lab) -> DataFrame:
    """Ranges planned on each key: every row is in exactly one, and none has far more rows than meant.

    A range may hold half as much again as meant, or a single key with more rows than that.
    """
    found = []
    for s, t, c in SPLIT:
        frame = lab.registry.table(s, t)
        rows = frame.count()
        conditions = ranges.planned_for(frame, c, max(1, -(-rows // RANGES)))
        hits = F.array(*[F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in conditions])
        number = F.array_position(hits, 1)
        by_key = frame.select(F.col(c).alias("key"), number.alias("number"),
                              F.aggregate(hits, F.lit(0), lambda a, x: a + x).alias("hits"))
        by_key = by_key.groupBy("key", "number", "hits").agg(F.count(F.lit(1)).alias("n"))
        by_range = by_key.groupBy("number").agg(
            F.sum("n").alias("n"), F.max("n").alias("hottest"),
            F.sum(F.when(F.col("hits") == 1, F.col("n")).otherwise(0)).alias("once"),
            F.sum(F.when(F.col("key").isNull(), F.col("n")).otherwise(0)).alias("nulls"),
        )
        allowed = F.lit(1.5 * rows / RANGES + 2) + F.col("hottest") + F.col("nulls")
        zero = F.lit(0).cast("bigint")
        found.append(by_range.agg(
            F.coalesce(F.sum("n"), zero).alias("row_count"), F.coalesce(F.sum("nulls"), zero).alias("null_keys"),
            F.coalesce(F.sum("once"), zero).alias("in_one_range"),
            F.coalesce(F.bool_and(F.col("n") <= allowed), F.lit(True)).alias("even"),
        ).select(F.lit(s).alias("schema_name"), F.lit(t).alias("table_name"), F.lit(c).alias("column_name"), "*"))
    return union_all(found)
