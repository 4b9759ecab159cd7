"""Tables the registered queries run on: the given ones, and dirty views derived from them.

The given tables are clean, so checks on them alone would prove nothing. The ``intake``
tables are views over whole given tables in which values of some kinds are replaced by
placeholders, NULLs or copies with errors. Spark and the oracle share the view text.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dqloom.operators.inventory import (
    FOREIGN_KEY,
    PRIMARY_KEY,
    UNIQUE,
    constraints_frame,
    key_rows,
)
from dqloom.sources import rules as rule_source
from dqloom.sources import snapshots
from dqloom.sources.registry import TableKey, TableRegistry

GIVEN = {
    "sales": ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"),
    "web_log": ("events", "pages"),
    "corpus": ("documents", "embeddings", "benchmark", "labels", "conversations"),
}
SCHEMA_OF = {table: schema for schema, tables in GIVEN.items() for table in tables}

# {name} is a given table; NTZ is the timestamp type without time zone
INTAKE = {
    "customer_record": """
        SELECT c_custkey AS customer_id,
               CASE c_nationkey WHEN 1 THEN 'N/A' WHEN 2 THEN ' unknown ' WHEN 3 THEN ''
                    WHEN 4 THEN '-' WHEN 5 THEN NULL ELSE c_name END AS full_name,
               CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS segment_code,
               CASE WHEN c_nationkey = 7 THEN c_mktsegment END AS ghi_chu,
               CASE WHEN c_acctbal < 0 THEN 'overdue' WHEN c_acctbal > 9000 THEN 'gold'
                    ELSE 'open' END AS account_status,
               CASE WHEN c_nationkey = 9 THEN c_name
                    ELSE concat(lower(replace(c_name, '#', '.')), '@example.com') END AS email,
               c_nationkey AS nation_code,
               c_acctbal AS balance
        FROM {customer}""",
    "item_catalog": """
        SELECT p_partkey AS item_id, p_brand AS brand, p_type AS loai,
               CASE p_size WHEN 1 THEN 9999 WHEN 2 THEN -1 WHEN 3 THEN 0 ELSE p_size END AS size_cm,
               p_retailprice AS price
        FROM {part}""",
    "order_record": """
        SELECT o_orderkey AS order_id,
               CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_custkey END AS customer_id,
               o_orderstatus AS status, o_totalprice AS total_amount,
               CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'
                    THEN CAST('1900-01-01 00:00:00' AS NTZ)
                    WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'P'
                    THEN CAST('1970-01-01 00:00:00' AS NTZ)
                    ELSE o_orderdate END AS ngay_dat
        FROM {orders}""",
    "order_line": """
        SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_partkey AS item_id,
               o_orderdate AS start_date, l_shipdate AS end_date, l_shipdate AS created_at,
               l_returnflag AS return_status, l_extendedprice AS amount
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    "order_copy": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id,
               CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'O' THEN 'X'
                    WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'F' THEN NULL
                    ELSE o_orderstatus END AS status
        FROM {orders}""",
    "event_history": """
        SELECT event_id, user_id, event_type AS state, ts AS event_at, value, props
        FROM {events}""",
    "account_archive": """
        SELECT c_custkey AS account_id, c_name AS account_number, c_acctbal AS balance
        FROM {customer} WHERE c_acctbal > 1000000""",
}

CONSTRAINTS = [
    *key_rows("pk_region", PRIMARY_KEY, "sales", "region", ["r_regionkey"]),
    *key_rows("pk_nation", PRIMARY_KEY, "sales", "nation", ["n_nationkey"]),
    *key_rows("pk_customer", PRIMARY_KEY, "sales", "customer", ["c_custkey"]),
    *key_rows("pk_supplier", PRIMARY_KEY, "sales", "supplier", ["s_suppkey"]),
    *key_rows("pk_part", PRIMARY_KEY, "sales", "part", ["p_partkey"]),
    *key_rows("pk_orders", PRIMARY_KEY, "sales", "orders", ["o_orderkey"]),
    *key_rows("uq_lineitem", UNIQUE, "sales", "lineitem", ["l_orderkey", "l_linenumber"]),
    *key_rows("pk_events", PRIMARY_KEY, "web_log", "events", ["event_id"]),
    *key_rows("pk_pages", PRIMARY_KEY, "web_log", "pages", ["page_id"]),
    *key_rows("pk_documents", PRIMARY_KEY, "corpus", "documents", ["doc_id"]),
    *key_rows("uq_conversations", UNIQUE, "corpus", "conversations", ["conv_id", "turn"]),
    *key_rows("pk_customer_record", PRIMARY_KEY, "intake", "customer_record", ["customer_id"]),
    *key_rows("pk_order_record", PRIMARY_KEY, "intake", "order_record", ["order_id"]),
    *key_rows("uq_order_line", UNIQUE, "intake", "order_line", ["order_id", "line_no"]),
    *key_rows("uq_customer_name", UNIQUE, "intake", "customer_record", ["full_name"]),
    *key_rows("pk_item", PRIMARY_KEY, "intake", "item_catalog", ["item_id"]),
    *key_rows("fk_nation", FOREIGN_KEY, "sales", "nation", ["n_regionkey"],
              ("sales", "pk_region"), "CASCADE", "NO ACTION"),
    *key_rows("fk_customer", FOREIGN_KEY, "sales", "customer", ["c_nationkey"],
              ("sales", "pk_nation"), "NO ACTION", "NO ACTION"),
    *key_rows("fk_supplier", FOREIGN_KEY, "sales", "supplier", ["s_nationkey"],
              ("sales", "pk_nation"), "NO ACTION", "NO ACTION"),
    *key_rows("fk_orders", FOREIGN_KEY, "sales", "orders", ["o_custkey"],
              ("sales", "pk_customer"), "NO ACTION", "CASCADE"),
    *key_rows("fk_line_order", FOREIGN_KEY, "sales", "lineitem", ["l_orderkey"],
              ("sales", "pk_orders"), "NO ACTION", "CASCADE"),
    *key_rows("fk_line_part", FOREIGN_KEY, "sales", "lineitem", ["l_partkey"],
              ("sales", "pk_part"), "NO ACTION", "NO ACTION"),
    *key_rows("fk_line_supplier", FOREIGN_KEY, "sales", "lineitem", ["l_suppkey"],
              ("sales", "pk_supplier"), "NO ACTION", "NO ACTION"),
    *key_rows("fk_labels", FOREIGN_KEY, "corpus", "labels", ["doc_id"],
              ("corpus", "pk_documents"), "NO ACTION", "CASCADE"),
    *key_rows("fk_order_record", FOREIGN_KEY, "intake", "order_record", ["customer_id"],
              ("intake", "pk_customer_record"), "NO ACTION", "NO ACTION"),
    *key_rows("fk_order_line", FOREIGN_KEY, "intake", "order_line", ["order_id"],
              ("intake", "pk_order_record"), "NO ACTION", "CASCADE"),
    *key_rows("fk_order_copy", FOREIGN_KEY, "intake", "order_copy", ["order_id"],
              ("intake", "pk_order_record"), "NO ACTION", "NO ACTION"),
    *key_rows("fk_line_pair", FOREIGN_KEY, "intake", "order_line", ["order_id", "line_no"],
              ("sales", "uq_lineitem"), "NO ACTION", "NO ACTION"),
]

# tables whose tier people have confirmed; all others are suggested or pending
TIERS = [
    ("sales", "customer", "1"), ("sales", "orders", "1"), ("sales", "lineitem", "1"),
    ("sales", "part", "tier 1"), ("sales", "nation", "2"), ("sales", "region", "2"),
    ("sales", "supplier", "3"), ("corpus", "documents", "1"), ("corpus", "labels", None),
    ("intake", "customer_record", "1"), ("intake", "order_record", "1"),
    ("intake", "order_line", "1"), ("intake", "order_copy", "1"),
    ("intake", "item_catalog", "1"), ("web_log", "events", "7"),
]


@dataclass
class Lab:
    """Registry, constraints and rules over one test folder."""

    spark: SparkSession
    folder: str

    def given(self, table: str) -> DataFrame:
        return self.registry.table(SCHEMA_OF[table], table)

    def intake(self, table: str) -> DataFrame:
        return self.registry.table("intake", table)

    @cached_property
    def registry(self) -> TableRegistry:
        return self.fresh_registry()

    def fresh_registry(self) -> TableRegistry:
        registry = TableRegistry(self.spark)
        for schema, tables in GIVEN.items():
            registry.add_files(schema, {t: f"{self.folder}/{t}.parquet" for t in tables})
        for name, text in INTAKE.items():
            registry.add("intake", name, lambda text=text: self.sql(text))
        return registry

    def scratch(self, name: str) -> str:
        """A new path in the shared folder; a local folder only for a local master."""
        local = self.spark.sparkContext.master.startswith("local")
        base = snapshots.shared_folder(self.spark, tempfile.gettempdir() if local else None)
        return f"{base}/{name}-{uuid.uuid4().hex}"

    def sql(self, text: str) -> DataFrame:
        """A derived table from SQL text that names given tables as ``{table}``."""
        used = {t: self.given(t) for t in SCHEMA_OF if "{" + t + "}" in text}
        return self.spark.sql(text.replace("NTZ", "TIMESTAMP_NTZ"), **used)

    @cached_property
    def constraints(self) -> DataFrame:
        return constraints_frame(self.spark, CONSTRAINTS)

    @cached_property
    def tiers(self) -> DataFrame:
        rows = [
            (f"{s}-{t}-tier", "confirmed" if tier else "need_check", "data-owner", s, t, tier)
            for s, t, tier in TIERS
        ]
        return self.spark.createDataFrame(rows, rule_source.TIER_SCHEMA)

    def keys(self, *schemas: str) -> list[TableKey]:
        return [key for key in self.registry.keys() if not schemas or key[0] in schemas]


ALL_TABLES = [(s, t) for s, tables in GIVEN.items() for t in tables] + [
    ("intake", name) for name in INTAKE
]


# --- texts for the oracle ------------------------------------------------------------


def intake_text(name: str) -> str:
    text = INTAKE[name].replace("NTZ", "TIMESTAMP")
    for table in SCHEMA_OF:
        text = text.replace("{" + table + "}", table)
    return text


def with_intake(*names: str) -> str:
    """``WITH`` clause that defines the named intake tables (all of them by default)."""
    return "WITH " + ", ".join(f"{n} AS ({intake_text(n)})" for n in names or INTAKE)


def over_tables(template: str, keys: Sequence[TableKey] = ALL_TABLES) -> str:
    """Union of a template over tables; ``$s`` is the schema, ``$t`` the table."""
    return " UNION ALL ".join(
        "(" + template.replace("$s", s).replace("$t", t) + ")" for s, t in keys
    )


COUNTS = over_tables(
    "SELECT '$s' AS schema_name, '$t' AS table_name, count(*) AS row_count FROM $t"
)
TYPE_NAMES = (
    "CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' "
    "WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' "
    "WHEN 'FLOAT[]' THEN 'array<float>' WHEN 'DATE' THEN 'date' ELSE column_type END"
)
COLUMNS = (
    "SELECT schema_name, table_name, column_name, "
    f"{TYPE_NAMES} AS data_type, position FROM ("
    + over_tables(
        "SELECT '$s' AS schema_name, '$t' AS table_name, column_name, column_type, "
        "CAST(row_number() OVER () AS INTEGER) AS position FROM (DESCRIBE SELECT * FROM $t)"
    )
    + ")"
)


def literal(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, (int, float)):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def values(rows: Sequence[Sequence[object]], names: str) -> str:
    listed = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return f"(SELECT * FROM (VALUES {listed}) v({names}))"


CONSTRAINT_ROWS = values(
    CONSTRAINTS,
    "constraint_name, constraint_type, schema_name, table_name, column_name, "
    "ordinal_position, ref_constraint, ref_schema, ref_position, update_rule, delete_rule",
)
TIER_ROWS = values(TIERS, "schema_name, table_name, tier")
TIER_ONE_ROWS = (
    f"(SELECT schema_name, table_name FROM {TIER_ROWS} "
    "WHERE trim(replace(lower(tier), 'tier', '')) IN ('1', '1.0'))"
)


def share(part: str, total: str, digits: int = 2) -> str:
    """Rounded percentage; ``printf`` rounds the stored double, not its shortest text."""
    exact = f"CAST({part} AS DOUBLE) / CAST({total} AS DOUBLE) * 100"
    return (
        f"CASE WHEN ({total}) = 0 THEN 0.0 ELSE "
        f"CAST(printf('%.{digits}f', {exact}) AS DOUBLE) END"
    )


# --- registration --------------------------------------------------------------------

Query = Callable[[Lab], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
PARTS: dict[str, str] = {}  # oracle texts for use inside others


def check(name: str, sql: str | None = None, shown: Sequence[str] = ()) -> Callable[[Query], Query]:
    """Register a query under a name, with its oracle text if there is one.

    ``shown`` columns may be NULL numbers; they are compared as text, since a table reader
    may turn a whole number column with NULLs into doubles.
    """

    def as_text(frame: DataFrame) -> DataFrame:
        for column in shown:
            text = F.coalesce(F.col(column).cast("string"), F.lit("none"))
            frame = frame.withColumn(column, text)
        return frame

    def register(query: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"Registered twice: {name}")
        QUERIES[name] = (lambda lab: as_text(query(lab))) if shown else query
        if sql is not None:
            PARTS[name] = sql
            texts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), 'none') AS {c}" for c in shown)
            ORACLE[name] = f"SELECT * REPLACE ({texts}) FROM ({sql})" if shown else sql
        return query

    return register
