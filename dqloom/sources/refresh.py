"""Column profiles that are refreshed by reading only the files that are new.

For every file of a table a row of mergeable statistics is kept: rows, and for each column NULLs,
bounds, the exact sum of whole numbers and decimals, a distinct-value sketch and a sketch of common
values. A refresh lists the table's files, reads those that are new or have changed, appends their
rows and merges all rows whose file is still there. So its work follows what was added; only the
merge, one row a file, follows the table.

Rows are only ever appended. Files that were replaced or removed no longer match the listing (name,
size and time), and a run that broke off or ran twice leaves rows that say the same, of which one
is taken. A table whose columns or types have changed starts anew, in a folder named by its schema.

Defined cases: an empty file counts zero rows; a table without files gives one row per column with
zeros and NULL bounds; arrays, maps and structs have no bounds; maps and variants no distinct count.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dqloom.functions import fixed_values as fixed
from dqloom.functions.numbers import round_half_even, share
from dqloom.functions.text import quoted
from dqloom.operators import profile

SKETCH_BITS = 14  # 2^14 registers: distinct counts within about 1 %
TRACKED = 1000  # common values a sketch tracks; exact for columns with fewer different values
IDENTITY = ("file_path", "file_size", "file_time")
LISTED = "file_path string, file_size bigint, file_time bigint"


@dataclass(frozen=True)
class Refresh:
    """What a refresh found: statistics of the files it read, and the profile of the whole table."""

    added: DataFrame
    profile: DataFrame


def listed_files(spark: SparkSession, path: str) -> DataFrame:
    """Data files below a folder: name, size and time, from the listing alone; no file is opened."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"path string, {LISTED}")
    return files.select(
        "path",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("file_size"),
        F.unix_micros("_metadata.file_modification_time").alias("file_time"),
    )


def _whole(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.IntegralType, T.DecimalType))


def _total_type(data_type: T.DataType) -> str:
    return f"decimal(38,{data_type.scale if isinstance(data_type, T.DecimalType) else 0})"


def _column_statistics(field: T.StructField) -> Column:
    """One struct of mergeable statistics. A field that a type has no value for is NULL."""
    kind, column = field.dataType, F.col(quoted(field.name))
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        column = F.when(column == 0, F.lit(0.0).cast(kind)).otherwise(column)  # no -0.0
    bound = column if profile.is_orderable(kind) else F.lit(None).cast("string")
    hashed = F.lit(None).cast("bigint")
    if not isinstance(kind, (T.MapType, T.VariantType)):
        hashed = F.when(column.isNotNull(), F.xxhash64(column))
    total = F.sum(column.cast(_total_type(kind))) if _whole(kind) else F.lit(None).cast("decimal(38,0)")
    return F.struct(
        F.count_if(column.isNull()).alias("nulls"),
        F.min(bound).alias("low"),
        F.max(bound).alias("high"),
        total.alias("total"),
        F.hll_sketch_agg(hashed, SKETCH_BITS).alias("sketch"),
        F.call_function("approx_top_k_accumulate", profile.sketched_value(column, kind), F.lit(TRACKED)).alias("common"),
    ).alias(field.name)


def file_statistics(frame: DataFrame) -> DataFrame:
    """One row of statistics per file of a table read from files, combined in tasks before the shuffle."""
    return frame.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(
        F.count(F.lit(1)).alias("rows"), F.struct(*map(_column_statistics, frame.schema)).alias("columns")
    )


def _literal_path(path: str) -> str:
    """A path whose name may hold characters that otherwise stand for patterns."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def refresh_profile(
    spark: SparkSession, path: str, state: str, schema: str, table: str,
    fmt: str = "parquet", columns: T.StructType | None = None, top: int = fixed.TOP_VALUES, **options: str,
) -> Refresh:
    """Profile of the files below ``path``, of which those already in ``state`` are not read.

    ``columns`` gives the table's columns; unset, they are read from the files. The names of new files
    go through the driver, as those of all files do whenever Spark plans a scan. The profile is saved
    below ``state`` before it is returned: Spark takes two listings of a folder for the same, so profiles
    of before and after a delivery would otherwise be mixed up within one query.
    """
    reader = spark.read.format(fmt).options(**options)
    columns = columns or reader.load(path).schema
    reader = reader.schema(columns)
    folder = f"{state}/{hashlib.md5(columns.json().encode()).hexdigest()}"
    files = listed_files(spark, path)
    try:
        known = spark.read.parquet(folder)
    except AnalysisException as problem:
        if problem.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        known = None
    new = files if known is None else files.join(known.select(*IDENTITY), list(IDENTITY), "left_anti")
    found = new.collect()
    if found:
        names = [row["path"] for row in found]
        source = reader.load(path) if known is None else (
            reader.option("basePath", path).load([_literal_path(name) for name in names])
        )
        listing = spark.createDataFrame(found, new.schema).drop("path")
        added = listing.join(file_statistics(source), "file_path", "left")
        run = f"{folder}/run=r{hashlib.md5(chr(10).join(sorted(names)).encode()).hexdigest()}"
        added.withColumn("rows", F.coalesce("rows", F.lit(0).cast("bigint"))).write.mode("append").parquet(run)
        known = spark.read.parquet(folder)
        added = spark.read.parquet(run).join(listing, list(IDENTITY), "left_semi").dropDuplicates(IDENTITY)
    else:
        added = spark.createDataFrame([], f"{LISTED}, rows bigint")
    if known is None:
        return Refresh(added, _empty(spark, columns, schema, table))
    current = known.join(files.select(*IDENTITY), list(IDENTITY), "left_semi").dropDuplicates(IDENTITY)
    saved = f"{state}/profile-{uuid.uuid4().hex}"
    merged_profile(current, columns, schema, table, top).write.parquet(saved)
    return Refresh(added, spark.read.schema(RESULT).parquet(saved))


def _empty(spark: SparkSession, columns: T.StructType, schema: str, table: str) -> DataFrame:
    rows = [(schema, table, c, 0, 0, None, 0, None, None, None, "") for c in columns.names]
    return spark.createDataFrame(rows, RESULT)


RESULT = (
    "schema_name string, table_name string, column_name string, total_rows bigint, null_count bigint, "
    "null_pct double, cardinality bigint, col_min string, col_max string, col_sum string, common_values string"
)


def merged_profile(
    statistics: DataFrame, columns: T.StructType, schema: str, table: str, top: int = fixed.TOP_VALUES
) -> DataFrame:
    """One row per column from rows of :func:`file_statistics`; partial results are merged in tasks.

    Rows, NULLs, bounds and sums are exact. Distinct counts and common values come from the merged sketches.
    """
    aggregates = [F.sum("rows").alias("rows")]
    for i, field in enumerate(columns):
        held = F.col("columns").getField(field.name)
        aggregates += [
            F.sum(held["nulls"]).alias(f"nulls{i}"),
            F.min(held["low"]).cast("string").alias(f"low{i}"),
            F.max(held["high"]).cast("string").alias(f"high{i}"),
            F.sum(held["total"]).cast("string").alias(f"total{i}"),
            F.hll_sketch_estimate(F.hll_union_agg(held["sketch"])).alias(f"distinct{i}"),
            F.call_function("approx_top_k_estimate",
                            F.call_function("approx_top_k_combine", held["common"], F.lit(TRACKED)),
                            F.lit(top + 1)).alias(f"common{i}"),
        ]
    zero = F.lit(0).cast("bigint")
    lines = [
        F.struct(
            F.lit(field.name).alias("column_name"), F.col("rows").alias("total_rows"),
            F.col(f"nulls{i}").alias("null_count"), F.col(f"distinct{i}").alias("sketched"),
            F.col(f"low{i}").alias("col_min"), F.col(f"high{i}").alias("col_max"),
            F.col(f"total{i}").alias("col_sum"), profile.common_of(F.col(f"common{i}"), top)["value"].alias("common"),
        )
        for i, field in enumerate(columns)
    ]
    # Spark does not merge sketches of nothing: files without rows stay out, and a group makes no row of none
    merged = statistics.filter("rows > 0").groupBy(F.lit(0).alias("whole")).agg(*aggregates)
    names = statistics.sparkSession.createDataFrame([(c,) for c in columns.names], "column_name string")
    found = names.join(merged.select(F.inline(F.array(*lines))), "column_name", "left")
    found = found.withColumns({c: F.coalesce(c, zero) for c in ("total_rows", "null_count", "sketched")})
    filled = F.col("total_rows") - F.col("null_count")
    return found.select(
        F.lit(schema).alias("schema_name"), F.lit(table).alias("table_name"), "column_name", "total_rows", "null_count",
        round_half_even(share(F.col("null_count"), F.col("total_rows")), 1).alias("null_pct"),
        F.least("sketched", filled).alias("cardinality"), "col_min", "col_max", "col_sum",
        F.coalesce(F.array_join("common", fixed.SAMPLE_SEPARATOR), F.lit("")).alias("common_values"),
    )
