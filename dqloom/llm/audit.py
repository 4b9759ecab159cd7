"""How filters overlap: which order of filters removes what, from a sparse document-term matrix.

``term_matrix`` gives every distinct word of the corpus a number (``blocks``: words are dealt by checksum, counted
within each task, and tasks start where those before them end) and builds the matrix of documents and
words in compressed sparse rows, one shard a block. The sum of a row is the number of words, its stored
entries are the distinct ones: they decide filters A and B. The other filters are flags of
the text, and E compares digests over the whole table. Documents are then counted by part and set of failed
filters, at most 32 sets a part, from which all 120 orders follow.

Null and empty texts have no words (an empty row); they are identical to each other. Rows without a
``doc_id`` are never and make none a later copy. A document with several labels is good or toxic if any row says so;
repeated rows count as often as they stand there. An empty table has no parts. Further columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from dqloom.functions.text import quoted
from dqloom.llm import blocks
from dqloom.llm.common import cut, drop
from dqloom.operators.keyed import spread_left_join

FILTERS = "ABCDE"
LEAST_WORDS = 50
LEAST_DISTINCT = 65  # percent of the words
MOST_CAPITALS = 5  # percent of the code points
SIGNS = b"#$%&*|"
CAPITALS = bytes(range(65, 91))
CONTINUED = bytes(range(128, 192))
LONG = 4_000_000


def words_of(text: str | None) -> Iterator[list[bytes]]:
    """Words between ASCII blanks."""
    rest = (text or "").encode()
    while len(rest) > LONG:
        some = rest.split(maxsplit=LONG // 8)
        rest = some.pop() if len(some) > LONG // 8 else b""
        yield some
    yield rest.split()


def text_flags(texts: pa.Array) -> dict[str, pa.Array]:
    """Failures of C and D and a digest of every text."""
    given = [(text or "").encode() for text in texts.to_pylist()]
    capitals = [100 * (len(t) - len(t.translate(None, CAPITALS))) > MOST_CAPITALS * len(t.translate(None, CONTINUED)) for t in given]
    return {
        "c": pa.array(capitals, pa.bool_()),
        "d": pa.array([len(t.translate(None, SIGNS)) < len(t) for t in given], pa.bool_()),
        "digest": pa.array([hashlib.sha256(t).digest() for t in given], pa.binary()),
    }


def _counter():
    """Numbers of words in the order in which a task meets them."""
    met = 0

    def numbers(words: list[str]) -> list[bytes]:
        nonlocal met
        data = np.arange(met, met + len(words), dtype=np.int64).tobytes()
        met += len(words)
        return [data[i : i + 8] for i in range(0, len(data), 8)]

    return numbers


def term_matrix(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Shards of the document-term matrix: rows, row pointers, column numbers and counts.

    ``rows`` are structs of ``row`` (the columns to keep), ``c``, ``d`` and ``digest``. Columns are numbers of words
    over the whole corpus, from 0 without gaps.
    """
    extra = ", c boolean, d boolean, digest binary"
    table = blocks.in_blocks(docs, "text", keep, words_of, extra, text_flags)
    numbered = blocks.worked_out(table, _counter, "numbered-words")
    # as many rows as the shuffle has tasks
    tasks = numbered.groupBy("part").agg(F.max("distinct").alias("n"))
    before = F.sum("n").over(Window.orderBy("part")) - F.col("n")
    offsets = tasks.select("part", before.alias("offset"))
    values = numbered.join(offsets, "part").select("block", "numbers", "sizes", "data", "offset")

    def make(own: pa.Table, words: np.ndarray, dictionary: pa.Table, _: pa.Table) -> pa.Table:
        counts = own.column("n_words").to_numpy()
        known = blocks.Values(dictionary)
        entries = [int.from_bytes(x[:8], "little") // 8 for x in dictionary.column("data").to_pylist()]
        numbers = known.data.view(np.int64) + np.repeat(dictionary.column("offset").to_numpy(), entries)
        known.data = numbers.view(np.uint8)
        document = np.repeat(np.arange(len(counts)), counts)
        cells, times = np.unique(document.astype(np.int64) << 40 | words, return_counts=True)
        columns = known.of(cells & ((1 << 40) - 1), 8)[0]
        pointers = np.searchsorted(cells >> 40, np.arange(len(counts) + 1))
        names = ("row", "c", "d", "digest")
        rows = pa.StructArray.from_arrays([own.column(name).combine_chunks() for name in names], list(names))

        def one(values: pa.Array) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

        return pa.table({
            "rows": one(rows), "pointers": one(pa.array(pointers, pa.int64())),
            "columns": one(pa.array(columns, pa.int64())), "counts": one(pa.array(times, pa.int64())),
        })

    row = StructType().add("row", docs.select(*map(quoted, keep)).schema, True)
    row = StructType(row.fields + StructType.fromDDL("c boolean, d boolean, digest binary").fields)
    schema = StructType().add("rows", ArrayType(row))
    for name in ("pointers", "columns", "counts"):
        schema.add(name, ArrayType(LongType()))
    shards = blocks.by_block(table, values, make, schema)
    shards._dqloom_cut = [table, numbered]
    return shards


def document_flags(shards: DataFrame) -> DataFrame:
    """``row``, ``n_words``, ``n_distinct`` and failures ``a`` to ``d`` of every document, and its digest.

    Sums and sizes of the matrix's rows.
    """
    rows = shards.schema["rows"].dataType.elementType
    schema = StructType([*rows.fields])
    for name in ("n_words", "n_distinct"):
        schema.add(name, "long")
    for name in "ab":
        schema.add(name, "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows, pointers, counts = (batch.column(k)[i].values for k in (0, 1, 2))
                pointers, sums = pointers.to_numpy(), blocks.edges(counts.to_numpy())
                n_words, n_distinct = np.diff(sums[pointers]), np.diff(pointers)
                columns = {name: rows.field(name) for name in rows.type.names}
                columns |= {"n_words": pa.array(n_words), "n_distinct": pa.array(n_distinct)}
                columns["a"] = pa.array(n_words < LEAST_WORDS)
                columns["b"] = pa.array(100 * n_distinct < LEAST_DISTINCT * n_words)
                yield pa.RecordBatch.from_pydict(columns)

    return shards.select("rows", "pointers", "counts").mapInArrow(run, schema)


def failed_sets(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents by ``part`` and set of failed filters (bit k for filter k): n, good and toxic ones."""
    shards = term_matrix(docs.select("doc_id", "source", "text"), ["doc_id", "source"])
    mask = sum((F.col(x).cast("int") * (1 << k) for k, x in enumerate("abcd")), F.lit(0))
    part = F.coalesce(F.col("row.source").cast("string"), F.lit(""))
    flagged = cut(document_flags(shards).select(F.col("row.doc_id").alias("doc_id"), part.alias("part"), mask.alias("mask"), "digest"), "flagged")
    for table in shards._dqloom_cut:
        drop(table)
    marks = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    marked = spread_left_join(flagged, marks, ["doc_id"])
    kinds = ["digest", "part", "mask", "good", "toxic"]
    # equal texts of a part are one row before they meet: the first id, how often it stands there, and all
    by_id = marked.groupBy(*kinds, "doc_id").agg(F.count(F.lit(1)).alias("n"))
    grouped = by_id.groupBy(*kinds).agg(
        F.sum("n").alias("n"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("first"),
        F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("nameless"),
    )
    least = flagged.where("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("least"))
    joined = grouped.join(least, "digest", "left")
    once = F.when(F.col("first.doc_id") == F.col("least"), F.col("first.n")).otherwise(F.lit(0)) + F.col("nameless")
    split = joined.select(
        "part", "good", "toxic",
        F.inline(F.array(
            F.struct(F.col("mask").alias("mask"), once.alias("n")),
            F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - once).alias("n")),
        )),
    ).where("n > 0")
    return split.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("good"), F.col("n")).otherwise(F.lit(0))).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(F.lit(0))).alias("toxic"),
    )


def _orders() -> Column:
    """All steps of all orders: the order, the step, its filter's bit, the bits of those before."""
    steps = []
    for order in permutations(range(len(FILTERS))):
        name = "".join(FILTERS[k] for k in order)
        for step, k in enumerate(order):
            earlier = sum(1 << j for j in order[:step])
            steps.append(f"{name},{step + 1},{FILTERS[k]},{1 << k},{earlier}")
    # one text that Spark takes apart: hundreds of literals would take the planner seconds
    fields = "filter_order string, step int, filter string, bit int, earlier int"
    return F.transform(F.split(F.lit(" ".join(steps)), " "), lambda step: F.from_csv(step, F.lit(fields)))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order and step: what its filter keeps, removes, repeats and loses."""
    sets = failed_sets(docs, labels).groupBy("part").agg(
        F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("sets")  # 32 at most
    )
    steps = sets.select("part", "sets", F.inline(_orders()))

    def total(what: str, chosen) -> Column:
        return F.aggregate(
            F.filter("sets", chosen), F.lit(0).cast("long"), lambda s, x: s + x[what]
        )

    bit, earlier = F.col("bit"), F.col("earlier")

    def fails(x: Column) -> Column:
        return x["mask"].bitwiseAND(bit) > 0

    def gone(x: Column) -> Column:
        return x["mask"].bitwiseAND(earlier) > 0

    def removed(x: Column) -> Column:
        return fails(x) & ~gone(x)

    # the first failing filter of an order removes a document: each one in an equal share of the 120
    shares = F.aggregate(
        F.filter("sets", fails), F.lit(0).cast("long"),
        lambda s, x: s + x["n"] * F.element_at(F.array(*[F.lit(120 // k) for k in range(1, 6)]), F.bit_count(x["mask"]).cast("int")),
    )
    return steps.select(
        "part", "filter_order", "step", "filter",
        total("n", lambda x: x["mask"].bitwiseAND(bit.bitwiseOR(earlier)) == 0).alias("kept"),
        total("n", removed).alias("removed"),
        total("n", lambda x: fails(x) & gone(x)).alias("redundant"),
        total("n", lambda x: x["mask"] == bit).alias("unique_fails"),
        total("good", removed).alias("good_lost"),
        total("toxic", removed).alias("toxic_lost"),
        shares.alias("shapley"),
    )
