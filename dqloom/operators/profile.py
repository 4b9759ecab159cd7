"""Column profiles: NULLs, distinct values, bounds, most common values."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dqloom.functions import fixed_values as fixed
from dqloom.functions import naming, text
from dqloom.functions.numbers import fixed_text, pct, round_half_even, share
from dqloom.functions.text import quoted
from dqloom.operators.keyed import union_all

#: Types that Spark's sketches of common values hold as they are.
SKETCHED = (
    T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DateType,
    T.TimestampType, T.TimestampNTZType,
)

NESTED = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
COLUMNS_PER_AGGREGATE = 100
PREFIX = 64  # characters that a late key keeps of a longer text
LONG_VALUE = 1024  # bytes from which a sketch holds a value's beginning and digest


def _labels(schema: str, table: str) -> list[Column]:
    return [F.lit(schema).alias("schema_name"), F.lit(table).alias("table_name")]


def is_orderable(data_type: T.DataType) -> bool:
    return not isinstance(data_type, (*NESTED, T.BinaryType))


def _batches(columns: Sequence[str]) -> list[Sequence[str]]:
    return [
        columns[i : i + COLUMNS_PER_AGGREGATE]
        for i in range(0, len(columns), COLUMNS_PER_AGGREGATE)
    ]


def _as_rows(row: DataFrame, columns: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Turn one wide row ``f0_a, f0_b, f1_a ..`` into one row per column."""
    return row.select(
        F.inline(
            F.array(*[
                F.struct(
                    F.lit(c).alias("column_name"),
                    *[F.col(f"f{i}_{f}").alias(f) for f in fields],
                )
                for i, c in enumerate(columns)
            ])
        )
    )


def column_counts(
    frame: DataFrame, schema: str, table: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Row and NULL counts and bounds of every column in one pass.

    Tables wider than ``COLUMNS_PER_AGGREGATE`` are read in column batches: each column
    is still read once.
    """
    results = []
    for batch in _batches(list(columns or frame.columns)):
        aggregates = []
        for i, c in enumerate(batch):
            column = F.col(quoted(c))
            ordered = is_orderable(frame.schema[c].dataType)
            bound = column if ordered else F.lit(None)
            if isinstance(frame.schema[c].dataType, (T.DoubleType, T.FloatType)):
                bound = F.when(column == 0, F.lit(0.0)).otherwise(column).cast(frame.schema[c].dataType)  # no -0.0
            aggregates += [
                F.count(F.lit(1)).alias(f"f{i}_total_rows"),
                F.count_if(column.isNull()).alias(f"f{i}_null_count"),
                F.min(bound).cast("string").alias(f"f{i}_col_min"),
                F.max(bound).cast("string").alias(f"f{i}_col_max"),
            ]
        results.append(
            _as_rows(frame.agg(*aggregates), batch,
                     ["total_rows", "null_count", "col_min", "col_max"])
        )
    return union_all(results).select(
        *_labels(schema, table),
        "column_name",
        "total_rows",
        "null_count",
        round_half_even(share(F.col("null_count"), F.col("total_rows")), 1).alias("null_pct"),
        "col_min",
        "col_max",
    )


def null_share(frame: DataFrame, schema: str, table: str) -> DataFrame:
    """NULL count and percentage per column; the percentage of an empty table is NULL."""
    results = []
    for batch in _batches(frame.columns):
        aggregates = []
        for i, c in enumerate(batch):
            aggregates += [
                F.count(F.lit(1)).alias(f"f{i}_total_rows"),
                F.count_if(F.col(quoted(c)).isNull()).alias(f"f{i}_null_count"),
            ]
        results.append(
            _as_rows(frame.agg(*aggregates), batch, ["total_rows", "null_count"])
        )
    return union_all(results).select(
        *_labels(schema, table),
        "column_name",
        "total_rows",
        "null_count",
        round_half_even(share(F.col("null_count"), F.col("total_rows")), 1).alias("null_pct"),
    )


def _slots(frame: DataFrame, columns: Sequence[str]) -> dict[T.DataType, str]:
    """One slot name per type that occurs among the columns."""
    types = dict.fromkeys(frame.schema[c].dataType for c in columns)
    return {data_type: f"v{i}" for i, data_type in enumerate(types)}


def _groupable(column: Column, data_type: T.DataType, short_text: bool) -> Column:
    if isinstance(data_type, T.MapType):
        return F.array_sort(F.map_entries(column))
    if isinstance(data_type, T.VariantType):
        return F.sha2(F.to_json(column), 256)
    return text.compact_key(column, short_text and isinstance(data_type, T.StringType))


def late_key(column: Column) -> Column:
    """A text of up to ``PREFIX`` characters as it is; of a longer one the beginning and a digest.

    Keys are equal if and only if the texts are, and in the order of the texts as far as their beginnings tell. A
    key of a longer text is longer than any short one.
    """
    digest = F.concat(F.left(column, F.lit(PREFIX)), F.lit("\x01"), F.sha2(column, 256))
    return F.when(F.char_length(column) > PREFIX, digest).otherwise(column)


def histogram(
    frame: DataFrame, columns: Sequence[str], short_text: bool = False, late: bool = False
) -> tuple[DataFrame, dict[T.DataType, str]]:
    """Frequency ``n`` of every value of every column, from one scan and one shuffle.

    Each cell becomes a row ``column_name, v0, v1, ..`` with one slot per column type, of
    which only the slot of the cell's type is filled: values keep their type and order and
    nothing is cast. Rows are unpivoted, which makes no objects of the cells, and equal cells are added up in
    every task before the shuffle.
    ``short_text`` groups long texts by digest, where only their number matters; ``late`` groups them by
    ``late_key``, where the texts of a few are looked up afterwards.

    One sum holds the frequency and, as its sign, whether the cell is set. So ``filled`` (not NULL) and ``sortable``
    come from an aggregate, and a filter on them stays above the shuffle: several uses of one histogram then
    share its scan and shuffle.
    """
    slots = _slots(frame, columns)
    cells, empty = [], {}
    for i, c in enumerate(columns):
        data_type = frame.schema[c].dataType
        value = _groupable(F.col(quoted(c)), data_type, short_text)
        if late and isinstance(data_type, T.StringType):
            value = late_key(value)
        cells.append(value.alias(f"c{i}"))
        empty.setdefault(slots[data_type], F.when(F.lit(False), value).alias(f"no_{slots[data_type]}"))
    wide = frame.select(*cells, *empty.values(), F.lit(None).cast("boolean").alias("no_more"))
    listed = []
    for i, c in enumerate(columns):
        own = slots[frame.schema[c].dataType]
        held = [f"c{i}" if slot == own else f"no_{slot}" for slot in slots.values()]
        listed.append(f"({', '.join([*held, 'no_more'])}) AS {quoted(c)}")
    named = ", ".join(listed).replace("{", "{{").replace("}", "}}")  # names may hold braces
    long = frame.sparkSession.sql(
        f"SELECT * FROM {{wide}} UNPIVOT INCLUDE NULLS (({', '.join([*slots.values(), 'more'])}) "
        f"FOR column_name IN ({named}))",
        wide=wide,
    )
    sign = F.when(_is_set(slots.values()), F.lit(1)).otherwise(F.lit(-1))
    sortable = [c for c in columns if is_orderable(frame.schema[c].dataType)]
    counted = (
        long.groupBy("column_name", *slots.values())
        .agg(F.sum(sign).alias("signed"))
        .select(
            "column_name", *slots.values(), F.abs("signed").alias("n"), (F.col("signed") > 0).alias("filled"),
            F.when(F.col("signed") > 0, F.col("column_name").isin(sortable)).otherwise(F.lit(False)).alias("sortable"),
        )
    )
    return counted, slots


def _is_set(slots: Iterable[str]) -> Column:
    return reduce(
        lambda left, right: left | right, [F.col(slot).isNotNull() for slot in slots], F.lit(False)
    )


def _text_of(slots: dict[T.DataType, str], aggregate=lambda column: column) -> Column:
    """The filled slot as text; nested types have none."""
    texts = [
        aggregate(F.col(slot)).cast("string")
        for data_type, slot in slots.items() if is_orderable(data_type)
    ]
    return F.coalesce(*texts, F.lit(None).cast("string"))


def value_counts(
    frame: DataFrame, schema: str, table: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Rows, NULLs and exact distinct values of every column, in one scan of the table.

    The NULL share of an empty table is NULL; NULL is not a distinct value. Long texts
    travel as digests.
    """
    columns = list(columns or frame.columns)
    values, slots = histogram(frame, columns, short_text=True)
    filled = F.col("filled")
    counted = values.groupBy("column_name").agg(
        F.sum("n").alias("total_rows"),
        F.sum(F.when(filled, F.lit(0)).otherwise(F.col("n"))).alias("null_count"),
        F.count_if(filled).alias("distinct_count"),
    )
    names = frame.sparkSession.createDataFrame([(c,) for c in columns], "column_name string")
    zero = F.lit(0).cast("bigint")
    return names.join(counted, "column_name", "left").select(
        *_labels(schema, table),
        "column_name",
        F.coalesce("total_rows", zero).alias("total_rows"),
        F.coalesce("null_count", zero).alias("null_count"),
        round_half_even(share(F.col("null_count"), F.col("total_rows")), 1).alias("null_pct"),
        F.coalesce("distinct_count", zero).alias("distinct_count"),
    )


def distinct_counts(
    frame: DataFrame, schema: str, table: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Exact distinct values per column, NULL not counted."""
    return value_counts(frame, schema, table, columns).select(
        "schema_name", "table_name", "column_name", "distinct_count"
    )


def approximate_distinct(
    frame: DataFrame, schema: str, table: str, rsd: float = 0.02
) -> DataFrame:
    """Distinct values per column from fixed-size sketches: one pass, no shuffle of values."""
    results = []
    for batch in _batches(frame.columns):
        row = frame.agg(*[
            F.approx_count_distinct(F.col(quoted(c)), rsd).alias(f"f{i}_distinct_count")
            for i, c in enumerate(batch)
        ])
        results.append(_as_rows(row, batch, ["distinct_count"]))
    return union_all(results).select(*_labels(schema, table), "column_name", "distinct_count")


def sketched_value(column: Column, data_type: T.DataType) -> Column:
    """A value as sketches of common values hold it: text, a long one as its beginning and a digest."""
    if not is_orderable(data_type):
        return F.lit(None).cast("string")
    shown = column.cast("string")
    marked = F.concat(F.left(shown, F.lit(fixed.MAX_CELL_CHARS)), F.lit("\x01"), F.sha2(shown, 256))
    return F.when(F.octet_length(shown) > LONG_VALUE, marked).otherwise(shown)


def common_of(found: Column, top: int) -> Column:
    """The ``top`` common values (value, n) of a sketch that was asked for one more.

    That one is needed because NULL may be among them. Equal counts are ordered by value, as in the
    exact profile; values that occur once are not common.
    """
    kept = F.filter(found, lambda item: item["item"].isNotNull() & (item["count"] > 1))
    ordered = F.array_sort(F.transform(
        kept, lambda item: F.struct((-item["count"]).alias("m"), item["item"].alias("value"))
    ))
    return F.transform(
        F.slice(ordered, 1, top),
        lambda item: F.struct(
            F.regexp_replace(item["value"], "\x01[0-9a-f]{64}$", "").alias("value"), (-item["m"]).alias("n")
        ),
    )


def approximate_profile(
    frame: DataFrame, schema: str, table: str, columns: Sequence[str] | None = None,
    top: int = fixed.TOP_VALUES, extra_pii: Sequence[str] = (), rsd: float = 0.02,
) -> DataFrame:
    """The column report of :func:`column_profile` from one pass without any shuffle of values.

    Counts and bounds are exact; distinct values and common values come from sketches of
    fixed size, so this is the profile for tables where an exact one is too dear. Values of more
    than ``LONG_VALUE`` bytes are told apart by digest and shown by their first
    ``MAX_CELL_CHARS`` characters, where report cells end anyway. Common values are exact where a
    column has few values.
    """
    fields = ["total_rows", "null_count", "cardinality", "col_min", "col_max", "top"]
    results = []
    for batch in _batches(list(columns or frame.columns)):
        aggregates = []
        for i, c in enumerate(batch):
            data_type = frame.schema[c].dataType
            column = _groupable(F.col(quoted(c)), data_type, False)
            ordered = is_orderable(data_type)
            bound = column if ordered else F.lit(None)
            # numbers and times are sketched as they are: only the few that a sketch names become text
            own = F.col(quoted(c))
            candidate = own if isinstance(data_type, SKETCHED) else sketched_value(own, data_type)
            aggregates += [
                F.count(F.lit(1)).alias(f"f{i}_total_rows"),
                F.count_if(column.isNull()).alias(f"f{i}_null_count"),
                F.approx_count_distinct(column, rsd).alias(f"f{i}_cardinality"),
                F.min(bound).cast("string").alias(f"f{i}_col_min"),
                F.max(bound).cast("string").alias(f"f{i}_col_max"),
                F.transform(
                    F.call_function("approx_top_k", candidate, F.lit(top + 1), F.lit(1000)),
                    lambda item: F.struct(item["item"].cast("string").alias("item"), item["count"].alias("count")),
                ).alias(f"f{i}_top"),
            ]
        results.append(_as_rows(frame.agg(*aggregates), batch, fields))
    found = union_all(results).withColumn("common", common_of(F.col("top"), top)).withColumn(
        "cardinality", F.least("cardinality", F.col("total_rows") - F.col("null_count"))
    )
    return _report(found, schema, table, extra_pii)


def most_common(
    frame: DataFrame, values: DataFrame, slots: dict[T.DataType, str], columns: Sequence[str],
    top: int = fixed.TOP_VALUES, at_least: int = 1,
) -> DataFrame:
    """The ``top`` most frequent values per column, ties by smaller value.

    ``values`` is a ``late`` histogram: no whole text is in it. Those whose count, and for long texts whose beginning, can
    be among the best are picked; the rank limit works in every task before the shuffle. Their texts come from a
    second pass over the text columns, which sends nothing but these texts, once a task.
    """
    texts = [slot for data_type, slot in slots.items() if isinstance(data_type, T.StringType)]
    ordered = [slot for data_type, slot in slots.items() if is_orderable(data_type)]
    known = [F.left(slot, F.lit(PREFIX)) if slot in texts else F.col(slot) for slot in ordered]
    by_column = Window.partitionBy("column_name")
    best = (
        values.filter(F.col("sortable") & (F.col("n") >= at_least))
        .withColumn("_place", F.rank().over(by_column.orderBy(F.desc("n"), *known)))
        .filter(F.col("_place") <= top)
        .select("column_name", "n", *ordered)
    )
    for slot in texts:
        kind = next(data_type for data_type, name in slots.items() if name == slot)
        cells = F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(quoted(c)).alias("text"))
            for c in columns if frame.schema[c].dataType == kind
        ])
        long = frame.select(F.inline(cells)).filter(F.char_length("text") > PREFIX)
        wanted = best.filter(F.char_length(slot) > PREFIX).select("column_name", slot)
        found = (
            long.select("column_name", late_key(F.col("text")).alias(slot), "text")
            .join(wanted, ["column_name", slot], "left_semi")
            .groupBy("column_name", slot).agg(F.any_value("text").alias("_text"))
        )
        best = best.join(found, ["column_name", slot], "left").select(
            "column_name", "n",
            *[F.coalesce("_text", slot).alias(slot) if other == slot else F.col(other) for other in ordered],
        )
    order = by_column.orderBy(F.desc("n"), *ordered)
    return (
        best.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= top)
        .select("column_name", "rank", _text_of(slots).alias("value"), "n")
    )


def top_values(
    frame: DataFrame, schema: str, table: str, columns: Sequence[str] | None = None,
    top: int = fixed.TOP_VALUES,
) -> DataFrame:
    """Rows ``column_name, rank, value, n`` of the most common values."""
    kept = [c for c in columns or frame.columns if is_orderable(frame.schema[c].dataType)]
    best = most_common(frame, *histogram(frame, kept, late=True), kept, top)
    return best.select(*_labels(schema, table), "column_name", "rank", "value", "n")


def column_profile(
    frame: DataFrame, schema: str, table: str, columns: Sequence[str] | None = None,
    top: int = fixed.TOP_VALUES, extra_pii: Sequence[str] = (),
) -> DataFrame:
    """The column report: counts, distinct share, bounds, common values, masked sample.

    Counts come from one shuffled histogram of values and digests of long texts, bounds from an aggregate of
    the scan, common values from the histogram and a late lookup. A value that occurs
    once is not common; a column without common values shows its minimum as the sample.
    """
    columns = list(columns or frame.columns)
    values, slots = histogram(frame, columns, late=True)
    filled = F.col("filled")
    summary = values.groupBy("column_name").agg(
        F.sum("n").alias("total_rows"),
        F.count_if(filled).alias("cardinality"),
        F.sum(F.when(filled, F.lit(0)).otherwise(F.col("n"))).alias("null_count"),
    )
    bounds = column_counts(frame, schema, table, columns).select("column_name", "col_min", "col_max")
    summary = summary.join(bounds, "column_name", "left")
    # at most ``top`` rows per column
    common = most_common(frame, values, slots, columns, top, at_least=2).groupBy("column_name").agg(
        F.array_sort(F.collect_list(F.struct("rank", "value", "n"))).alias("common")
    )
    return _report(summary.join(common, "column_name", "left"), schema, table, extra_pii)


def _report(
    found: DataFrame, schema: str, table: str, extra_pii: Sequence[str]
) -> DataFrame:
    """Texts of the column report from ``total_rows .. col_max`` and ``common`` (value, n)."""
    total = F.col("total_rows")
    personal = naming.is_personal(
        F.lit(schema), F.lit(table), F.col("column_name"), extra=extra_pii
    )
    shares = F.transform(
        "common", lambda item: F.concat(fixed_text(share(item["n"], total), 1), F.lit("%"))
    )
    listed = F.array_join(F.col("common.value"), fixed.SAMPLE_SEPARATOR)
    sample = F.coalesce(F.when(listed != "", listed), F.col("col_min"), F.lit(""))
    return found.select(
        *_labels(schema, table),
        "column_name",
        "total_rows",
        "cardinality",
        F.coalesce(
            F.concat(fixed_text(share(F.col("cardinality"), total), 1), F.lit("%")), F.lit("")
        ).alias("distinct_pct"),
        "null_count",
        pct(F.col("null_count"), total, 1).alias("null_pct"),
        F.coalesce("col_min", F.lit("")).alias("col_min"),
        F.coalesce("col_max", F.lit("")).alias("col_max"),
        F.coalesce(F.array_join(shares, fixed.SAMPLE_SEPARATOR), F.lit("")).alias(
            "most_common_freqs"
        ),
        F.when(personal & (sample != ""), text.mask_sample(sample)).otherwise(sample).alias(
            "sample"
        ),
        personal.alias("pii_phi"),
    )


def stats_lookup(
    columns: DataFrame, profile: DataFrame, tables: DataFrame, analyzed: DataFrame | None = None
) -> DataFrame:
    """Column statistics for every inventory column.

    A column without statistics says why: its table is empty, or it was not profiled. ``analyzed``
    (``schema_name, table_name, last_analyze``, as :func:`dqloom.sources.snapshots.freshness` gives) adds
    ``last_analyzed``, the time of the table's last analysis; NULL where it never was.
    """
    by = ["schema_name", "table_name", "column_name"]
    joined = columns.join(profile, by, "left").join(
        tables.select("schema_name", "table_name", F.col("row_count").alias("_rows")),
        ["schema_name", "table_name"],
        "left",
    )
    found = F.col("total_rows").isNotNull()
    reason = F.when(F.col("_rows") == 0, F.lit("EMPTY_TABLE")).otherwise(F.lit("NOT_PROFILED"))

    def blank(name: str, empty: Column) -> Column:
        return F.when(found, F.col(name)).otherwise(empty).alias(name)

    when = []
    if analyzed is not None:
        times = analyzed.groupBy("schema_name", "table_name").agg(F.max("last_analyze").alias("last_analyzed"))
        joined = joined.join(times, ["schema_name", "table_name"], "left")
        when = ["last_analyzed"]
    return joined.select(
        *by,
        *when,
        blank("total_rows", F.lit(0)),
        blank("cardinality", F.lit(0)),
        blank("distinct_pct", F.lit("")),
        blank("null_count", F.lit(0)),
        blank("null_pct", F.lit(0.0)),
        blank("col_min", F.lit("")),
        blank("col_max", F.lit("")),
        blank("most_common_freqs", F.lit("")),
        blank("sample", reason),
    )
