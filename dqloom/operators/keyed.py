"""Building blocks that stay balanced when one key holds a large part of all rows.

Everything here reduces rows on the map side before a shuffle, spreads hot keys over
several tasks, or both. Nothing collects a group in one task, nothing is dropped.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dqloom.functions.text import compact_key, quoted

KeyPairs = Sequence[tuple[str, str]]

MOST_TRACKED = 1_000_000  # counters of the sketch that finds hot keys: its upper bound in Spark
FINER = 8  # parts a half partition of a hot key is cut into, so that tasks that get several are still even
TEXT_KEYS = 4  # text columns a grouping key may have before they become one digest


def all_not_null(columns: Sequence[str]) -> Column:
    return reduce(lambda left, right: left & right, [F.col(quoted(c)).isNotNull() for c in columns])


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name, built as a balanced tree.

    Every step analyses the plan below it, so a chain over many tables would cost the
    driver the square of their number.
    """
    if not frames:
        raise ValueError("Nothing to unite")
    level = list(frames)
    while len(level) > 1:
        level = [
            level[i].unionByName(level[i + 1]) if i + 1 < len(level) else level[i]
            for i in range(0, len(level), 2)
        ]
    return level[0]


def grouping_keys(frame: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Grouping keys ``k0, k1, ..`` of complete rows, small whatever the columns hold.

    Numbers and times are kept as they are. Up to ``TEXT_KEYS`` text columns are kept,
    long values as digests; more text columns become one SHA-256 digest, so that a check
    over a whole table of texts shuffles 32 bytes for them and not the table.
    """
    texts = [c for c in columns if isinstance(frame.schema[c].dataType, T.StringType)]
    if len(texts) <= TEXT_KEYS:
        keys = [compact_key(F.col(quoted(c)), c in texts) for c in columns]
    else:
        # the length before each text tells texts apart that read alike when strung together
        whole = F.concat(*[
            F.concat(F.char_length(quoted(c)).cast("string"), F.lit(":"), F.col(quoted(c))) for c in texts
        ])
        keys = [F.unhex(F.sha2(whole, 256)), *[F.col(quoted(c)) for c in columns if c not in texts]]
    return [key.alias(f"k{i}") for i, key in enumerate(keys)]


def key_presence(child: DataFrame, parent: DataFrame, pairs: KeyPairs) -> DataFrame:
    """Per complete child key: how many child rows, and whether a parent row has it.

    Child and parent keys meet in one aggregate of their union, so both sides are combined
    before they are shuffled and a hot key arrives as one row per task. No join, hence no
    broadcast to size and no multiplication by duplicate parents.
    """
    child_keys, parent_keys = [c for c, _ in pairs], [p for _, p in pairs]
    names = [f"k{i}" for i in range(len(pairs))]
    uses = child.filter(all_not_null(child_keys)).select(
        *[F.col(quoted(c)).alias(n) for c, n in zip(child_keys, names)],
        F.lit(1).cast("bigint").alias("uses"),
        F.lit(False).alias("known"),
    )
    known = parent.filter(all_not_null(parent_keys)).select(
        *[F.col(quoted(p)).alias(n) for p, n in zip(parent_keys, names)],
        F.lit(0).cast("bigint").alias("uses"),
        F.lit(True).alias("known"),
    )
    return (
        uses.unionByName(known)
        .groupBy(*names)
        .agg(F.sum("uses").alias("uses"), F.max("known").alias("known"))
    )


def key_hash(frame: DataFrame, keys: Sequence[str]) -> Column:
    """Hash that is equal for equal keys; -0.0 and 0.0 are one key."""
    floats = (T.FloatType, T.DoubleType)
    return F.xxhash64(*[
        F.col(quoted(k)) + F.lit(0.0) if isinstance(frame.schema[k].dataType, floats)
        else F.col(quoted(k))
        for k in keys
    ])


def frequent_hashes(frame: DataFrame, keys: Sequence[str]) -> dict[int, int]:
    """Hashes of the keys that would fill more than half a shuffle partition, with the number of
    half partitions that each fills.

    The share above which a key is hot and the number of its parts follow the session's number
    of shuffle partitions n: a share of 1 / 2n is hot, so there are at most 2n hot keys. One pass
    over the key columns with a sketch of fixed size finds them. It is read when the plan is
    built, so that both sides of a join and every recomputation of a lost task use the same list.
    """
    return _hot_keys(frame, keys)[0]


def _hot_keys(frame: DataFrame, keys: Sequence[str]) -> tuple[dict[int, int], int]:
    """:func:`frequent_hashes`, the most frequent first, and the rows of half a partition."""
    parts = 2 * int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    items = min(parts, MOST_TRACKED // 16)
    top = f"approx_top_k(hashed, {items}, {items * 16})"
    found = frame.select(key_hash(frame, keys).alias("hashed")).agg(
        F.expr(top).alias("top"), F.count(F.lit(1)).alias("total")
    ).first()
    share = found["total"] / parts
    half = max(1, int(share))
    return {
        item["item"]: -(-item["count"] // half) for item in found["top"] if item["count"] > share
    }, half


def spread_left_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], hot_from: DataFrame | None = None
) -> DataFrame:
    """Left join on ``keys``, where ``right`` has at most one row per key.

    Hot keys of the left side are spread over as many tasks as their rows would fill half
    partitions, in ``FINER`` parts each, and only their right rows are repeated. Rows of hot keys
    that are equal in all columns are added up, dealt to the parts by their count and made rows again
    behind the join, so that even a key whose rows are all equal is spread evenly. Rows with a NULL
    key match nothing, so they are spread freely. Adaptive skew handling cannot do this here, because
    the right side ends in an aggregate.

    Hot keys are looked up in ``hot_from``, a cheaper table with the same keys, when
    ``left`` is itself the outcome of a shuffle. Which keys count as hot changes the
    balance of the tasks, never the result.
    """
    left, right = _with_common_types(left, right, keys)
    base = left if hot_from is None else _with_common_types(left, hot_from, keys)[1]
    hot, half = _hot_keys(base.filter(all_not_null(keys)), keys)
    free = 2 * int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def is_hot(frame: DataFrame) -> Column:
        # a set of literals is looked up by hash
        return F.coalesce(key_hash(frame, keys).isin(*hot), F.lit(False)) & all_not_null(keys)

    def parts(frame: DataFrame) -> Column:
        if not hot:
            return F.lit(1)
        listed = F.create_map(*[F.lit(x) for pair in hot.items() for x in (pair[0], pair[1] * FINER)])
        return F.when(is_hot(frame), F.try_element_at(listed, key_hash(frame, keys))).otherwise(F.lit(1))

    columns = left.columns
    # The number of the map task spreads equal rows as well. It is the same when a lost
    # task runs again, which a row number or a random number need not be.
    others = [quoted(c) for c in columns if not isinstance(left.schema[c].dataType, T.MapType)]
    scattered = F.xxhash64(*others, F.spark_partition_id())
    dealt = bool(hot) and all(_adds_up(left.schema[c].dataType) for c in columns)
    if dealt:
        cold = left.filter(~is_hot(left)).select(
            "*", F.lit(1).cast("bigint").alias("_spread_copies"), scattered.alias("_spread_place")
        )
        warm = _dealt(left.filter(is_hot(left)), max(1, half // FINER))
        left, scattered = cold.unionByName(warm), F.col("_spread_place")
    own = F.when(all_not_null(keys), parts(left)).otherwise(F.lit(free))
    salted = left.withColumn("_salt", F.pmod(scattered, own).cast("int"))
    every = F.sequence(F.lit(0), (parts(right) - 1).cast("int")) if hot else F.array(F.lit(0))
    repeated = right.withColumn("_salt", F.explode(every))
    joined = salted.join(repeated, [*keys, "_salt"], "left").drop("_salt")
    if dealt:
        joined = joined.withColumn("_spread_place", F.explode(F.sequence(F.lit(1), F.col("_spread_copies").cast("int"))))
        joined = joined.drop("_spread_copies", "_spread_place")
    return joined


def _adds_up(data_type: T.DataType) -> bool:
    """Whether grouping by values of a type gives them back as they were (signs of zeros are kept apart)."""
    if isinstance(data_type, T.StringType):
        return data_type.isUTF8BinaryCollation()
    return not isinstance(data_type, (T.ArrayType, T.MapType, T.StructType, T.VariantType))


def _dealt(frame: DataFrame, most: int) -> DataFrame:
    """Equal rows as one with their number ``_spread_copies``, cut into pieces of at most ``most``; pieces have places in a row."""
    floats = [c for c in frame.columns if isinstance(frame.schema[c].dataType, (T.DoubleType, T.FloatType))]
    signs = {c: f"_spread_negative{i}" for i, c in enumerate(floats)}
    marked = frame.withColumns({
        sign: F.coalesce(F.col(quoted(c)).cast("string") == "-0.0", F.lit(False)) for c, sign in signs.items()
    })
    counted = marked.groupBy(*map(quoted, marked.columns)).agg(F.count(F.lit(1)).alias("_spread_all"))
    piece = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_spread_all") - 1) / most)))
    pieces = counted.withColumn("_spread_piece", piece)
    restored = [
        F.when(F.col(signs[c]), F.lit(-0.0).cast(frame.schema[c].dataType)).otherwise(F.col(quoted(c))).alias(c)
        if c in signs else F.col(quoted(c)) for c in frame.columns
    ]
    # places are far from the greatest long, so that adding a piece's number never overflows
    place = F.shiftright(F.xxhash64(*map(quoted, marked.columns)), 1) + F.col("_spread_piece")
    return pieces.select(
        *restored, F.least(F.lit(most), F.col("_spread_all") - F.col("_spread_piece") * most).cast("bigint").alias("_spread_copies"),
        place.alias("_spread_place"),
    )


def _with_common_types(
    left: DataFrame, right: DataFrame, keys: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Bring the keys of both sides to one type, so that equal keys hash alike."""
    names = [quoted(k) for k in keys]
    common = left.select(*names).unionByName(right.select(*names)).schema
    for k in keys:
        wanted = common[k].dataType
        if left.schema[k].dataType != wanted:
            left = left.withColumn(k, F.col(quoted(k)).cast(wanted))
        if right.schema[k].dataType != wanted:
            right = right.withColumn(k, F.col(quoted(k)).cast(wanted))
    return left, right


def with_presence(
    left: DataFrame, right: DataFrame, pairs: KeyPairs, flag: str = "known"
) -> DataFrame:
    """Add whether any row of ``right`` has the row's key; False for incomplete keys."""
    keys = [a for a, _ in pairs]
    known = (
        right.select(*[F.col(quoted(b)).alias(a) for a, b in pairs])
        .filter(all_not_null(keys))
        .distinct()
        .withColumn(flag, F.lit(True))
    )
    joined = spread_left_join(left, known, keys)
    return joined.select(*map(quoted, left.columns), F.coalesce(flag, F.lit(False)).alias(flag))


def pair_agreement(
    left: DataFrame, right: DataFrame, pairs: KeyPairs, values: tuple[str, str], keep_nulls: bool
) -> DataFrame:
    """Count the pairs of an equi-join and those whose two values agree, without the pairs.

    With p and c rows of a key on either side the join has p*c pairs; those that agree are
    the sum of p*c per value. Both come from counts per (key, value), so duplicates on
    both sides never multiply. ``keep_nulls`` keeps NULL values: NULL agrees with NULL.
    """
    names = [f"k{i}" for i in range(len(pairs))]

    def side(frame: DataFrame, keys: list[str], value: str, is_left: bool) -> DataFrame:
        return frame.filter(all_not_null(keys)).select(
            *[F.col(quoted(k)).alias(n) for k, n in zip(keys, names)],
            compact_key(
                F.col(quoted(value)), isinstance(frame.schema[value].dataType, T.StringType)
            ).alias("value"),
            F.lit(int(is_left)).cast("bigint").alias("p"),
            F.lit(int(not is_left)).cast("bigint").alias("c"),
        )

    per_value = (
        side(left, [a for a, _ in pairs], values[0], True)
        .unionByName(side(right, [b for _, b in pairs], values[1], False))
        .groupBy(*names, "value")
        .agg(F.sum("p").alias("p"), F.sum("c").alias("c"))
    )
    # NULL values are left out of the sums, not of the rows: checks of both policies then share one shuffle
    p, c = (F.col(n) if keep_nulls else F.when(F.col("value").isNotNull(), F.col(n)).otherwise(0) for n in "pc")
    per_key = per_value.groupBy(*names).agg(F.sum(p).alias("p"), F.sum(c).alias("c"), F.sum(p * c).alias("same"))
    return per_key.agg(
        F.coalesce(F.sum(F.col("p") * F.col("c")), F.lit(0)).alias("checked_count"),
        F.coalesce(F.sum("same"), F.lit(0)).alias("agreeing_count"),
    )


def group_sizes(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per complete key: the keys and ``record_count``."""
    kept = frame.filter(all_not_null(columns))
    keyed = kept.select(*grouping_keys(kept, columns))
    return keyed.groupBy(*keyed.columns).agg(F.count(F.lit(1)).alias("record_count"))


#: A history is cut only where it has more rows than this, and than half a shuffle partition.
LEAST_SEGMENT = 10_000
SAMPLED = 50  # rows that the sample of a segment has, about


def _order_of(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(quoted(c)).alias(f"o{i}") for i, c in enumerate(order)])


def split_points(frame: DataFrame, entity: Sequence[str], order: Sequence[str]) -> DataFrame | None:
    """Where the histories of large entities are cut: e0, e1, ... and the sorted ``points``, or nothing.

    A sample by hash of the row's place, some ``SAMPLED`` rows a segment, tells which entities fill more than half a
    shuffle partition and where in (time, tie) order each half ends. There are about two points a partition; they
    are read when the plan is built, so every use and every recomputation cuts alike.
    """
    parts = 2 * int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = frame.count()
    segment = max(LEAST_SEGMENT, total // parts)
    if total <= segment:
        return None
    every = max(1, segment // SAMPLED)
    names = [f"e{i}" for i in range(len(entity))]
    place = F.xxhash64(*[F.col(quoted(c)) for c in (*entity, *order)])
    sample = frame.where(F.pmod(place, F.lit(every)) == 0).select(
        *[F.col(quoted(c)).alias(n) for c, n in zip(entity, names)], _order_of(order).alias("o")
    )
    of_entity = Window.partitionBy(*names)
    numbered = sample.select(
        "*", F.row_number().over(of_entity.orderBy("o")).alias("i"), F.count(F.lit(1)).over(of_entity).alias("n")
    )
    step = max(1, segment // every)
    chosen = numbered.where((F.col("n") > step) & (F.col("i") % step == 0))
    points = chosen.groupBy(*names).agg(F.sort_array(F.collect_set("o")).alias("points"))
    found = points.collect()
    return frame.sparkSession.createDataFrame(found, points.schema) if found else None


def scanned(
    frame: DataFrame,
    entity: Sequence[str],
    order: Sequence[str],
    previous: Sequence[str] = (),
    version: bool = False,
    running_max: str | None = None,
) -> DataFrame:
    """Histories in ``order``: ``prev_<value>`` of the row before, ``version`` from 1, ``max_before``.

    A segmented scan. Large entities are cut at ``split_points``, rows are ordered once per (entity, segment), and what a
    segment hands on to the next (its rows, its maximum, its last values) is added up before the shuffle and joined back as
    one row per segment of a large entity. So neither an entity with most of the rows nor the NULL entity nor
    many rows at one time are ordered in one task; only rows equal in all columns of the order stay together.
    Rows equal in the order are told apart by their other columns.
    """
    points = split_points(frame, entity, order)
    keys = [quoted(e) for e in entity]
    whole = F.xxhash64(*[F.col(quoted(c)) for c in frame.columns if not isinstance(frame.schema[c].dataType, T.MapType)])
    placed = frame.withColumn("_row", whole)
    if points is None:
        placed = placed.withColumn("_segment", F.lit(0))
    else:
        listed = F.broadcast(points)  # about two points a shuffle partition
        same = [F.col(quoted(e)).eqNullSafe(points[f"e{i}"]) for i, e in enumerate(entity)]
        met = placed.join(listed, functools.reduce(operator.and_, same), "left")
        before = F.size(F.filter("points", lambda point: point < _order_of(order)))
        placed = met.withColumn("_segment", F.when(F.col("points").isNull(), 0).otherwise(before + 1))
    inside = Window.partitionBy(*keys, "_segment").orderBy(*map(quoted, order), "_row")
    values = F.struct(*[F.col(quoted(v)).alias(f"v{i}") for i, v in enumerate(previous)]) if previous else F.lit(None)
    highest = F.col(quoted(running_max)) if running_max else F.lit(None)
    ranked = placed.select(
        *[F.col(quoted(c)) for c in frame.columns], "_segment",
        F.row_number().over(inside).alias("_number"),
        F.lag(values).over(inside).alias("_prev"),
        F.max(highest).over(inside.rowsBetween(Window.unboundedPreceding, -1)).alias("_max"),
    )
    if points is not None:
        names = [f"_e{i}" for i in range(len(entity))]
        large = placed.where("_segment > 0").select(
            *[F.col(quoted(e)).alias(n) for e, n in zip(entity, names)], F.col("_segment").alias("_s"),
            values.alias("v"), highest.alias("h"), F.struct(_order_of(order).alias("o"), "_row").alias("o"),
        )
        summed = large.groupBy(*names, "_s").agg(
            F.count(F.lit(1)).alias("n"), F.max("h").alias("h"), F.max_by("v", "o").alias("v")
        )
        across = Window.partitionBy(*names).orderBy("_s")
        earlier = across.rowsBetween(Window.unboundedPreceding, -1)
        handed = summed.select(
            *names, "_s", F.sum("n").over(earlier).alias("_n"), F.max("h").over(earlier).alias("_h"),
            F.lag("v").over(across).alias("_v"),
        )
        same = [F.col(quoted(e)).eqNullSafe(F.col(n)) for e, n in zip(entity, names)]
        ranked = ranked.join(handed, functools.reduce(operator.and_, [*same, F.col("_segment") == F.col("_s")]), "left")
        ranked = ranked.withColumn("_prev", F.when(F.col("_number") == 1, F.col("_v")).otherwise(F.col("_prev")))
        ranked = ranked.withColumn("_number", F.col("_number") + F.coalesce("_n", F.lit(0)))
        ranked = ranked.withColumn("_max", F.greatest("_max", "_h"))
    added = [F.col(f"_prev.v{i}").alias(f"prev_{v}") for i, v in enumerate(previous)]
    added += [F.col("_number").cast("bigint").alias("version")] if version else []
    added += [F.col("_max").alias("max_before")] if running_max else []
    return ranked.select(*[F.col(quoted(c)) for c in frame.columns], *added)
