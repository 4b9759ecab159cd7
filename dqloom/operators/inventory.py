"""Inventories of tables, columns and declared keys."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dqloom.functions import naming, text
from dqloom.operators.keyed import union_all
from dqloom.sources.registry import TableKey, TableRegistry

CONSTRAINT_SCHEMA = (
    "constraint_name string, constraint_type string, schema_name string, table_name string, "
    "column_name string, ordinal_position int, ref_constraint string, ref_schema string, "
    "ref_position int, update_rule string, delete_rule string"
)
PRIMARY_KEY, UNIQUE, FOREIGN_KEY = "PRIMARY KEY", "UNIQUE", "FOREIGN KEY"


def key_rows(
    name: str, kind: str, schema: str, table: str, columns: Sequence[str],
    references: tuple[str, str] | None = None,
    update_rule: str | None = None, delete_rule: str | None = None,
) -> list[tuple]:
    """Rows of one declared key; ``references`` is (schema, constraint name) of a foreign key."""
    ref_schema, ref_constraint = references or (None, None)
    return [
        (name, kind, schema, table, column, i, ref_constraint, ref_schema,
         i if references else None, update_rule, delete_rule)
        for i, column in enumerate(columns, 1)
    ]


def constraints_frame(spark: SparkSession, rows: Iterable[tuple]) -> DataFrame:
    return spark.createDataFrame(list(rows), CONSTRAINT_SCHEMA)


def row_counts(registry: TableRegistry, keys: Iterable[TableKey] | None = None) -> DataFrame:
    """``schema_name, table_name, row_count``; a count reads no column."""
    return union_all([
        registry.table(s, t).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(s).alias("schema_name"), F.lit(t).alias("table_name"), "row_count"
        )
        for s, t in (registry.keys() if keys is None else keys)
    ])


def file_sizes(registry: TableRegistry, keys: Iterable[TableKey] | None = None) -> DataFrame:
    """Bytes on storage per table, from the file listing; no file is opened.

    Views and database tables have no files of their own and count 0.
    """
    frames = []
    for s, t in registry.keys() if keys is None else keys:
        path = registry.location(s, t)
        if path is None:
            size = registry.spark.range(1).select(F.lit(0).cast("bigint").alias("total_bytes"))
        else:
            size = (
                registry.spark.read.format("binaryFile")
                .option("recursiveFileLookup", "true")
                .load(path)
                .agg(F.coalesce(F.sum("length"), F.lit(0)).alias("total_bytes"))
            )
        frames.append(
            size.select(F.lit(s).alias("schema_name"), F.lit(t).alias("table_name"), "total_bytes")
        )
    return union_all(frames)


def column_inventory(
    registry: TableRegistry, keys: Iterable[TableKey] | None = None
) -> DataFrame:
    """One row per column, taken from the schemas; no data is read."""
    rows = []
    for s, t in registry.keys() if keys is None else keys:
        for position, f in enumerate(registry.table(s, t).schema.fields, 1):
            kind = f.dataType.simpleString()
            full = f.metadata.get("__CHAR_VARCHAR_TYPE_STRING", kind)
            rows.append((
                s, t, f.name, kind.split("(")[0] if kind.endswith(")") else kind, full, f.nullable,
                f.metadata.get("CURRENT_DEFAULT"), position, f.metadata.get("comment", ""),
            ))
    return registry.spark.createDataFrame(
        rows,
        "schema_name string, table_name string, column_name string, data_type string, "
        "full_type string, nullable boolean, default string, position int, comment string",
    )


def key_flags(columns: DataFrame, constraints: DataFrame) -> DataFrame:
    """Add ``pk, fk, uq``; a column in several constraints stays one row."""

    def of_kind(kind: str) -> Column:
        return F.bool_or(F.col("constraint_type") == kind)

    flags = constraints.groupBy("schema_name", "table_name", "column_name").agg(
        of_kind(PRIMARY_KEY).alias("pk"),
        of_kind(FOREIGN_KEY).alias("fk"),
        of_kind(UNIQUE).alias("uq"),
    )
    joined = columns.join(flags, ["schema_name", "table_name", "column_name"], "left")
    return joined.select(
        *columns.columns, *[F.coalesce(F.col(k), F.lit(False)).alias(k) for k in ("pk", "fk", "uq")]
    )


def key_counts(constraints: DataFrame) -> DataFrame:
    """Number of primary and foreign keys per table."""

    def count_of(kind: str) -> Column:
        return F.count_distinct(F.when(F.col("constraint_type") == kind, F.col("constraint_name")))

    return constraints.groupBy("schema_name", "table_name").agg(
        count_of(PRIMARY_KEY).alias("has_pk"), count_of(FOREIGN_KEY).alias("fk_count")
    )


def table_inventory(
    registry: TableRegistry,
    constraints: DataFrame,
    keys: Iterable[TableKey] | None = None,
    sizes: bool = True,
    counts: DataFrame | None = None,
    total_bytes: DataFrame | None = None,
) -> DataFrame:
    """One row per table: counts, bytes, keys and timestamp columns, ordered by name.

    ``counts`` and ``total_bytes`` are given where they were worked out before.
    """
    keys = registry.keys() if keys is None else list(keys)
    by = ["schema_name", "table_name"]
    columns = column_inventory(registry, keys)
    shape = columns.groupBy(*by).agg(
        F.count(F.lit(1)).alias("column_count"),
        timestamp_list().alias("ts_columns"),
    )
    frame = (row_counts(registry, keys) if counts is None else counts).join(shape, by, "left")
    frame = frame.join(key_counts(constraints), by, "left").join(registry.tables(), by, "left")
    if sizes:
        measured = file_sizes(registry, keys) if total_bytes is None else total_bytes
        frame = frame.join(measured, by, "left")
    else:
        frame = frame.withColumn("total_bytes", F.lit(None).cast("bigint"))
    return frame.select(
        *by,
        F.coalesce("comment", F.lit("")).alias("comment"),
        "row_count",
        F.coalesce("column_count", F.lit(0)).alias("column_count"),
        "total_bytes",
        F.coalesce("has_pk", F.lit(0)).alias("has_pk"),
        F.coalesce("fk_count", F.lit(0)).alias("fk_count"),
        F.coalesce("ts_columns", F.lit("")).alias("ts_columns"),
        F.lit("BASE TABLE").alias("table_type"),
    ).orderBy(*by)


def timestamp_list() -> Column:
    """Aggregate over a column inventory: names of the timestamp columns, sorted."""
    name = F.when(
        naming.is_timestamp_column(F.col("column_name"), F.col("data_type")), F.col("column_name")
    )
    return F.array_join(F.array_sort(F.collect_list(name)), ", ")


def schema_summary(tables: DataFrame) -> DataFrame:
    """Tables and bytes per schema, from a table inventory."""
    return tables.groupBy("schema_name").agg(
        F.count_distinct("table_name").alias("table_count"),
        F.coalesce(F.sum("total_bytes"), F.lit(0)).alias("total_bytes"),
    )


def foreign_key_edges(constraints: DataFrame, schema: str | None = None) -> DataFrame:
    """Foreign-key columns paired with the referenced key column of the same position."""
    fk = constraints.filter(F.col("constraint_type") == FOREIGN_KEY)
    if schema is not None:
        fk = fk.filter(F.col("schema_name") == schema)
    child = fk.select(
        "constraint_name",
        F.col("schema_name").alias("from_schema"),
        F.col("table_name").alias("from_table"),
        F.col("column_name").alias("from_column"),
        F.col("ref_schema").alias("to_schema"),
        "ref_constraint",
        "ref_position",
        "update_rule",
        "delete_rule",
        F.col("ordinal_position").alias("column_position"),
    )
    parent = constraints.filter(F.col("constraint_type").isin(PRIMARY_KEY, UNIQUE)).select(
        F.col("schema_name").alias("to_schema"),
        F.col("constraint_name").alias("ref_constraint"),
        F.col("ordinal_position").alias("ref_position"),
        F.col("table_name").alias("to_table"),
        F.col("column_name").alias("to_column"),
        F.col("constraint_type").alias("referenced_key_type"),
    )
    edges = child.join(parent, ["to_schema", "ref_constraint", "ref_position"])
    return edges.select(
        "constraint_name", "from_schema", "from_table", "from_column",
        "to_schema", "to_table", "to_column", "referenced_key_type",
        "update_rule", "delete_rule", "column_position",
    ).orderBy("from_schema", "from_table", "constraint_name", "column_position")


def tier_one_edges(edges: DataFrame, tiers: DataFrame) -> DataFrame:
    """Edges whose two ends are tier 1, with their label."""
    first = tiers.filter(naming.is_tier_one(F.col("tier")))
    for end in ("from", "to"):
        side = first.select(
            F.col("schema_name").alias(f"{end}_schema"), F.col("table_name").alias(f"{end}_table")
        )
        edges = edges.join(side, [f"{end}_schema", f"{end}_table"], "left_semi")
    label = text.edge_label(
        [F.col(f"from_{part}") for part in ("schema", "table", "column")],
        [F.col(f"to_{part}") for part in ("schema", "table", "column")],
    )
    return edges.withColumn("relationship", label)


def composite_keys(
    frame: DataFrame, by: Sequence[str], position: str, columns: Sequence[str]
) -> DataFrame:
    """One row per constraint with its columns as arrays in key order."""
    ordered = F.array_sort(F.collect_list(F.struct(position, *columns)))
    grouped = frame.groupBy(*by).agg(ordered.alias("_keys"))
    return grouped.select(*by, *[F.col(f"_keys.{c}").alias(c) for c in columns])


def implicit_foreign_keys(columns: DataFrame, constraints: DataFrame) -> DataFrame:
    """Columns named like a key that no foreign or primary key covers."""
    by = ["schema_name", "table_name", "column_name"]
    declared = constraints.filter(F.col("constraint_type").isin(FOREIGN_KEY, PRIMARY_KEY))
    return (
        columns.filter(naming.looks_like_key(F.col("column_name")))
        .join(declared.select(*by), by, "left_anti")
        .select(*by, "data_type", naming.likely_table(F.col("column_name")).alias("likely_table"))
    )


def parse_table_tokens(raw: str) -> list[str]:
    """``"a, s.b"`` as lower-case tokens, blanks and quotes removed."""
    tokens = [item.strip().strip('"').strip("'").lower() for item in raw.split(",")]
    return [token for token in tokens if token]


def matching_tables(tables: DataFrame, tokens: Sequence[str]) -> DataFrame:
    """Tables named by a token as ``table`` or ``schema.table``; all when there is none."""
    if not tokens:
        return tables
    table = F.lower("table_name")
    full = F.concat_ws(".", F.lower("schema_name"), table)
    return tables.filter(table.isin(*tokens) | full.isin(*tokens))


def unmatched_tokens(tables: DataFrame, tokens: Sequence[str]) -> DataFrame:
    wanted = tables.sparkSession.createDataFrame([(t,) for t in tokens], "token string")
    known = tables.select(
        F.explode(
            F.array(F.lower("table_name"),
                    F.concat_ws(".", F.lower("schema_name"), F.lower("table_name")))
        ).alias("token")
    )
    return wanted.join(known, "token", "left_anti")


def scope_report(
    tokens: Sequence[str],
    tables: DataFrame,
    columns: DataFrame,
    implicit: DataFrame,
    edges: DataFrame,
) -> dict[str, DataFrame]:
    """Keep the chosen tables and what belongs to them; edges follow their child table."""
    kept = matching_tables(tables, tokens)
    chosen = kept.select("schema_name", "table_name")
    by = ["schema_name", "table_name"]
    from_chosen = chosen.select(
        F.col("schema_name").alias("from_schema"), F.col("table_name").alias("from_table")
    )
    return {
        "tables": kept,
        "columns": columns.join(chosen, by, "left_semi"),
        "implicit": implicit.join(chosen, by, "left_semi"),
        "edges": edges.join(from_chosen, ["from_schema", "from_table"], "left_semi"),
        "schemas": kept.groupBy("schema_name").agg(F.count(F.lit(1)).alias("table_count")),
    }


def require_match(report: dict[str, DataFrame], tokens: Sequence[str]) -> None:
    """Stop when a non-empty choice names no table at all."""
    if tokens and report["tables"].isEmpty():
        raise ValueError(f"No table matches {', '.join(tokens)}")


def run_summary(
    tables: DataFrame, columns: DataFrame, edges: DataFrame, implicit: DataFrame,
    extra_pii: Sequence[str] = (),
) -> DataFrame:
    """Counters of a run as ``item, count`` rows."""
    personal = naming.is_personal(
        F.col("schema_name"), F.col("table_name"), F.col("column_name"), extra=extra_pii
    )
    counters = [
        ("schemas", tables.select("schema_name").distinct()),
        ("tables", tables),
        ("columns", columns),
        ("foreign_keys", edges),
        ("implicit_foreign_keys", implicit),
        ("pii_columns", columns.filter(personal)),
    ]
    return union_all([
        frame.agg(F.count(F.lit(1)).alias("count")).select(F.lit(item).alias("item"), "count")
        for item, frame in counters
    ])
