"""The tables under test, addressed as (schema, table)."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dqloom.functions import fixed_values as fixed
from dqloom.sources import ranges as ranges_of

TableKey = tuple[str, str]


@dataclass
class TableRegistry:
    """Lazily opened tables; opening reads only footers or catalog entries."""

    spark: SparkSession
    openers: dict[TableKey, Callable[[], DataFrame]] = field(default_factory=dict)
    comments: dict[TableKey, str] = field(default_factory=dict)
    paths: dict[TableKey, str] = field(default_factory=dict)
    _opened: dict[TableKey, DataFrame] = field(default_factory=dict)

    def add(
        self,
        schema: str,
        table: str,
        source: DataFrame | Callable[[], DataFrame],
        comment: str = "",
    ) -> TableRegistry:
        key = (schema, table)
        self.openers[key] = (lambda: source) if isinstance(source, DataFrame) else source
        self.comments[key] = comment
        self._opened.pop(key, None)
        return self

    def add_files(
        self, schema: str, paths: Mapping[str, str], fmt: str = "parquet", **options: str
    ) -> TableRegistry:
        """Tables kept as files: parquet, orc, json or csv."""
        for table, path in paths.items():
            self.add(
                schema, table,
                lambda path=path: self.spark.read.format(fmt).options(**options).load(path),
            )
            self.paths[(schema, table)] = path
        return self

    def add_catalog(self, database: str) -> TableRegistry:
        """Every non-temporary table of a Spark catalog database."""
        for entry in self.spark.catalog.listTables(database):
            if not entry.isTemporary:
                self.add(
                    database, entry.name,
                    lambda name=entry.name: self.spark.table(f"`{database}`.`{name}`"),
                    entry.description or "",
                )
                if entry.tableType != "VIEW":
                    location = (
                        self.spark.sql(f"DESCRIBE TABLE EXTENDED `{database}`.`{entry.name}`")
                        .filter(F.col("col_name") == "Location")
                        .first()
                    )
                    if location is not None:
                        self.paths[(database, entry.name)] = location["data_type"]
        return self

    def add_jdbc(
        self,
        schema: str,
        tables: Iterable[str],
        url: str,
        ranges: Mapping[str, tuple[str, int, int, int]] | None = None,
        split_by: Mapping[str, str] | None = None,
        rows_per_task: int = ranges_of.ROWS_PER_TASK,
        **properties: str,
    ) -> TableRegistry:
        """Tables of a relational database, opened read-only.

        ``ranges`` gives (column, lower, upper, partitions) of a table. ``split_by`` gives only the
        column: bounds and cuts are then found in the data when the table is opened, so that every
        task reads about ``rows_per_task`` rows however uneven the keys are (:mod:`dqloom.sources.ranges`).
        A table in neither is read by one task.
        """
        for table in tables:
            column = (split_by or {}).get(table)
            options = jdbc_options(schema, table, url, (ranges or {}).get(table), properties)

            def opened(table=table, column=column, options=options) -> DataFrame:
                if column is None or table in (ranges or {}):
                    return self.spark.read.format("jdbc").options(**options).load()
                source = ranges_of.JdbcTable(self.spark, schema, table, url, properties)
                return source.load(column, rows_per_task)

            self.add(schema, table, opened)
        return self

    def table(self, schema: str, table: str) -> DataFrame:
        key = (schema, table)
        if key not in self.openers:
            raise ValueError(f"Table not found: {schema}.{table}")
        if key not in self._opened:
            self._opened[key] = self.openers[key]()
        return self._opened[key]

    def location(self, schema: str, table: str) -> str | None:
        """Folder or file of a table kept as files."""
        return self.paths.get((schema, table))

    def by_reference(self, reference: str) -> DataFrame:
        """Open ``schema.table`` or the table of ``schema.table.column``."""
        parts = reference.split(".")
        if len(parts) not in (2, 3) or not all(parts):
            raise ValueError(f"Expected schema.table or schema.table.column: {reference!r}")
        return self.table(parts[0], parts[1])

    def keys(self, schema: str | None = None) -> list[TableKey]:
        return sorted(
            key for key in self.openers
            if not is_system_schema(key[0]) and (schema is None or key[0] == schema)
        )

    def tables(self) -> DataFrame:
        """One row per table: ``schema_name, table_name, comment``."""
        return self.spark.createDataFrame(
            [(s, t, self.comments[(s, t)]) for s, t in sorted(self.openers)],
            "schema_name string, table_name string, comment string",
        )


def is_system_schema(name: str) -> bool:
    # LIKE, so an underscore of the pattern stands for any character
    temporary = fixed.TEMP_SCHEMA_LIKE.replace("_", ".").replace("%", ".*")
    return name in fixed.SYSTEM_SCHEMAS or re.fullmatch(temporary, name) is not None


def user_schemas(tables: DataFrame) -> DataFrame:
    """Sorted schema names without system and temporary schemas."""
    name = F.col("schema_name")
    return (
        tables.filter(~name.isin(*fixed.SYSTEM_SCHEMAS))
        .filter(~name.like(fixed.TEMP_SCHEMA_LIKE))
        .select("schema_name")
        .distinct()
        .orderBy("schema_name")
    )


def jdbc_options(
    schema: str,
    table: str,
    url: str,
    key_range: tuple[str, int, int, int] | None,
    properties: Mapping[str, str],
) -> dict[str, str]:
    options = {"url": url, "dbtable": f'"{schema}"."{table}"', **properties}
    if key_range:
        column, lower, upper, partitions = key_range
        options |= {
            "partitionColumn": column, "lowerBound": str(lower),
            "upperBound": str(upper), "numPartitions": str(partitions),
        }
    return options
