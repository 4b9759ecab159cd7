"""Documents in blocks, each with a dictionary of its own words.

A block is about ``BLOCK_BYTES`` of text from one task. Its documents are written as sequences of word
numbers, the commonest word first, in bytes of seven bits, and its distinct words once. Every word
stands at most once in a block, so the entries of even the commonest word are as many as there are blocks.
``worked_out`` deals the words of all blocks to buckets by checksum, keeps the distinct words of one bucket in a
table, works out one value for each, and sends the values back to the blocks, where ``Values`` looks
them up by number. There are as many buckets as ``BUCKET_WORDS`` entries each ask for, so the table stays small
at any size of the corpus.

Null texts are empty. Documents without words have an empty sequence; a block without words has no
dictionary. Memory follows a block, or the longest text where that is larger.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from dqloom.functions.text import quoted
from dqloom.llm.common import cut, drop, give_back, ship

BLOCK_BYTES = 16 << 20
BUCKET_WORDS = 100_000
CHUNK_WORDS = 500_000
WORDS_A_ROW = 200_000
HELD_ROWS = 500_000
GATHERED = 100_000
HELD_BYTES = 32 << 20
VALUES = "block long, kind int, numbers binary, sizes binary, data binary, part int, distinct long"


def squeezed(data: bytes | np.ndarray) -> bytes:
    """Bytes after their length, compressed."""
    data = bytes(data)
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def restored(parts: list[bytes]) -> bytes:
    """The bytes of several compressed parts, one after the other."""
    return b"".join(
        pa.decompress(part[8:], decompressed_size=int.from_bytes(part[:8], "little"), codec="zstd", asbytes=True)
        for part in parts
    )


def packed(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers as bytes of seven bits, low ones first, and how many bytes each has."""
    numbers = numbers.astype(np.uint32)
    sizes = np.ones(len(numbers), np.int64)
    for k in (7, 14, 21, 28):
        sizes += numbers >= np.uint32(1 << k)
    at = np.cumsum(sizes) - sizes
    out = np.empty(int(sizes.sum()), np.uint8)
    for k in range(5):
        own = np.flatnonzero(sizes > k) if k else slice(None)
        if k and not len(own):
            break
        more = (sizes[own] > k + 1).astype(np.uint8) << 7
        out[at[own] + k] = (numbers[own] >> np.uint32(7 * k)).astype(np.uint8) & 127 | more
    return out, sizes


def unpacked(data: bytes) -> np.ndarray:
    """The numbers again."""
    bytes_ = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero(bytes_ < 128)
    starts = np.concatenate([np.zeros(1, np.int64), ends[:-1] + 1]) if len(ends) else ends
    numbers = (bytes_[starts] & 127).astype(np.int64)
    sizes = ends - starts + 1
    for k in range(1, 5):
        own = np.flatnonzero(sizes > k)
        if not len(own):
            break
        numbers[own] |= (bytes_[starts[own] + k] & 127).astype(np.int64) << (7 * k)
    return numbers


class Numbers(dict):
    """Numbers of words, given at first sight."""

    def __missing__(self, word) -> int:
        self[word] = number = len(self)
        return number


def binary_column(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Binary values that follow each other in ``data``."""
    offsets = np.concatenate([np.zeros(1, np.int64), ends])
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
    ).cast(pa.binary())


def in_blocks(
    docs: DataFrame,
    column: str,
    keep: list[str],
    words_of: Callable[[object], Iterator[list]],
    extra: str = "",
    extra_of: Callable[[pa.Array], dict[str, pa.Array]] | None = None,
) -> DataFrame:
    """The block table, written to the shared folder.

    Rows of kind "texts" hold some documents of a block: structs of ``row`` (the columns to keep), ``n_words`` and
    extra columns, and the cells with their word numbers. Rows of kind "words" hold distinct words of a block,
    numbered from ``first``. ``words_of`` gives the words of a value in lists of any length, ``extra_of`` further
    columns of a batch.
    """
    ship(docs.sparkSession)
    row = F.struct(*[F.col(quoted(c)) for c in keep]).alias("row")
    given = docs.select(F.col(quoted(column)).alias("value"), row)
    document = StructType().add("row", given.schema["row"].dataType, True)
    document = StructType(document.fields + StructType.fromDDL("n_words long" + extra).fields)
    schema = StructType.fromDDL("block long, first int, words array<string>, cells binary, kind string")
    schema.add("docs", ArrayType(document), True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        numbers, size = Numbers(), 0
        held: list[tuple[pa.StructArray, np.ndarray]] = []  # documents and the numbers of their words
        kind = None

        def rows() -> Iterator[pa.RecordBatch]:
            times = np.zeros(len(numbers), np.int64)
            for _, cells in held:
                times += np.bincount(cells, minlength=len(numbers))
            order = np.argsort(-times, kind="stable")
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            for documents, cells in held:
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([block], pa.int64()),
                    "first": pa.nulls(1, pa.int32()),
                    "words": pa.nulls(1, pa.list_(pa.string())),
                    "cells": pa.array([squeezed(packed(rank[cells])[0])], pa.binary()),
                    "kind": pa.array(["texts"]),
                    "docs": pa.ListArray.from_arrays(pa.array([0, len(documents)], pa.int32()), documents),
                })
            words = list(numbers)
            for first in range(0, len(words), WORDS_A_ROW):
                some = [words[i] for i in order[first : first + WORDS_A_ROW].tolist()]
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([block], pa.int64()),
                    "first": pa.array([first], pa.int32()),
                    "words": pa.array([some], pa.list_(pa.string())),
                    "cells": pa.nulls(1, pa.binary()),
                    "kind": pa.array(["words"]),
                    "docs": pa.nulls(1, pa.list_(kind)),
                })

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                start, counts, cells, met = at, [], [np.zeros(0, np.int64)], 0
                while at < batch.num_rows and size < BLOCK_BYTES and met < CHUNK_WORDS:
                    value = batch.column(0)[at]
                    n = 0
                    for words in words_of(value.as_py()):
                        cells.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
                        n += len(words)
                    counts.append(n)
                    size += len(value.as_buffer()) if value.is_valid else 0
                    met += n
                    at += 1
                # a copy, so that the batch can go
                kept = batch.column(1).take(pa.array(np.arange(start, at)))
                columns = {"row": kept, "n_words": pa.array(counts, pa.int64())}
                columns |= extra_of(batch.column(0)[start:at]) if extra_of else {}
                documents = pa.StructArray.from_arrays(list(columns.values()), list(columns))
                kind = documents.type
                held.append((documents, np.concatenate(cells).astype(np.int32)))
                if size >= BLOCK_BYTES:
                    yield from rows()
                    held.clear()
                    block, numbers, size = block + 1, Numbers(), 0
        if held:
            yield from rows()

    return cut(given.mapInArrow(run, schema), "blocks", "kind")


def _gathered(
    groups: Iterator[tuple[np.ndarray, np.ndarray, pa.Array]], kind: int, distinct: Callable[[], int]
) -> Iterator[pa.RecordBatch]:
    """Blocks, numbers and values as few rows a block: numbers (differences), sizes and bytes."""
    part = TaskContext.get().partitionId()
    held: list[tuple[np.ndarray, np.ndarray, pa.Array]] = []

    def rows() -> Iterator[pa.RecordBatch]:
        block, number = (np.concatenate([h[k] for h in held]) for k in (0, 1))
        order = np.lexsort((number, block))
        block, number = block[order], number[order]
        value = pa.concat_arrays([h[2] for h in held]).take(pa.array(order))
        offsets = np.frombuffer(value.buffers()[1], np.int64)[value.offset : value.offset + len(value) + 1]
        data = value.buffers()[2]
        bounds = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1], [True]]))
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            own = data[offsets[a] : offsets[b]].to_pybytes() if data else b""
            yield pa.RecordBatch.from_pydict({
                "block": pa.array([block[a]], pa.int64()),
                "kind": pa.array([kind], pa.int32()),
                "numbers": pa.array([squeezed(packed(np.diff(number[a:b], prepend=0))[0])], pa.binary()),
                "sizes": pa.array([squeezed(packed(np.diff(offsets[a : b + 1]))[0])], pa.binary()),
                "data": pa.array([squeezed(own)], pa.binary()),
                "part": pa.array([part], pa.int32()),
                "distinct": pa.array([distinct()], pa.int64()),
            })
        held.clear()

    count = size = 0
    for group in groups:
        held.append(group)
        count, size = count + len(group[0]), size + group[2].nbytes
        if count >= HELD_ROWS or size >= HELD_BYTES:
            yield from rows()
            count = size = 0
    if held:
        yield from rows()


def _dealt(table: DataFrame) -> DataFrame:
    """The words of each block by bucket, brought together and sorted by bucket."""
    listed = table.where("kind = 'words'").select("block", "first", "words")
    entries = listed.agg(F.coalesce(F.sum(F.size("words")), F.lit(0))).first()[0]
    buckets = -(-max(1, entries) // BUCKET_WORDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block, first, words = (column[i].as_py() for column in batch.columns)
                coded = [word.encode() for word in words]
                bucket = np.array([zlib.crc32(word) for word in coded], np.int64) % buckets
                order = np.argsort(bucket, kind="stable")
                bounds = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
                rows = []
                for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                    own = order[a:b]
                    some = [coded[i] for i in own.tolist()]
                    sizes = packed(np.array([len(word) for word in some]))[0]
                    numbers = packed(np.diff(own + first, prepend=0))[0]
                    rows.append((bucket[own[0]], block, numbers.tobytes(), sizes.tobytes(), squeezed(b"".join(some))))
                columns = list(zip(*rows))
                kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
                names = ("bucket", "block", "numbers", "sizes", "data")
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], list(names))

    schema = "bucket long, block long, numbers binary, sizes binary, data binary"
    return listed.mapInArrow(run, schema).repartition("bucket").sortWithinPartitions("bucket")


def worked_out(table: DataFrame, make: Callable[[], Callable[[list[str]], list[bytes]]], name: str) -> DataFrame:
    """One value for each distinct word of a block table, sent to the word's places in all blocks.

    ``make()``'s function is asked for each distinct word once. ``part`` and ``distinct`` tell the task and how many
    words it had met. Result: rows of ``VALUES``, kind 0, written to the shared folder; the words of the block table are
    removed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value_of, met, current = make(), 0, None
        known: dict[str, bytes] = {}

        def groups() -> Iterator[tuple[np.ndarray, np.ndarray, pa.Array]]:
            nonlocal met, current
            for batch in batches:
                for bucket, block, numbers, sizes, data in zip(*(column.to_pylist() for column in batch.columns)):
                    if bucket != current:
                        known.clear()
                        current = bucket
                    ends, whole = edges(unpacked(sizes)).tolist(), restored([data])
                    words = [whole[a:b].decode() for a, b in zip(ends, ends[1:])]
                    new = [word for word in words if word not in known]
                    known.update(zip(new, value_of(new)))
                    met += len(new)
                    values = pa.array(map(known.__getitem__, words), pa.large_binary(), size=len(words))
                    yield np.full(len(words), block), np.cumsum(unpacked(numbers)), values

        yield from _gathered(groups(), 0, lambda: met)

    found = cut(_dealt(table).mapInArrow(run, VALUES), name)
    drop(table, "kind=words")
    return found


def gathered(found: DataFrame, kind: int) -> DataFrame:
    """(block, number, value) as rows of ``VALUES``."""
    ship(found.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = (
            (batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).cast(pa.large_binary()))
            for batch in batches if batch.num_rows
        )
        yield from _gathered(groups, kind, lambda: 0)

    return found.mapInArrow(run, VALUES)


class Values:
    """Values of a block's numbers, from its rows of ``VALUES``."""

    def __init__(self, rows: pa.Table) -> None:
        parts = [np.cumsum(unpacked(restored([x]))) for x in rows.column("numbers").to_pylist()]
        numbers = np.concatenate([np.zeros(0, np.int64), *parts])
        sizes = unpacked(restored(rows.column("sizes").to_pylist()))
        self.data = np.frombuffer(restored(rows.column("data").to_pylist()), np.uint8)
        most = int(numbers.max()) + 1 if len(numbers) else 0
        self.start, self.size = np.zeros(most, np.int64), np.zeros(most, np.int64)
        self.start[numbers], self.size[numbers] = np.cumsum(sizes) - sizes, sizes

    def of(self, numbers: np.ndarray, width: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """Values of these numbers after each other, in units of ``width`` bytes, and each one's length."""
        units = self.data.view({1: np.uint8, 4: np.uint32, 8: np.int64}[width])
        sizes = (self.size[numbers] // width).astype(np.int32)
        found, done = np.empty(int(sizes.sum()), units.dtype), 0
        for first in range(0, len(numbers), GATHERED):  # places take more room than values
            some = sizes[first : first + GATHERED]
            at = np.repeat(self.start[numbers[first : first + GATHERED]] // width - (np.cumsum(some) - some), some)
            at += np.arange(len(at))
            found[done : done + len(at)] = units[at]
            done += len(at)
        return found, sizes


def by_block(
    table: DataFrame, values: DataFrame, make: Callable[[pa.Table, np.ndarray, pa.Table, pa.Table], pa.Table],
    schema: StructType, more: DataFrame | None = None,
) -> DataFrame:
    """``make`` of each block: its documents, the numbers of their words, and its values.

    ``more`` are rows of ``VALUES`` that come with the documents, for ``make``'s last argument.
    """
    given = ["numbers", "sizes", "data"]

    def of_block(own: pa.Table, dictionary: pa.Table) -> pa.Table:
        texts = own.filter(pc.is_valid(own.column("cells")))
        docs = pa.concat_arrays([chunk.flatten() for chunk in texts.column("docs").chunks])
        documents = pa.Table.from_arrays(docs.flatten(), names=docs.type.names)
        cells = [unpacked(restored([c.as_py()])).astype(np.int32) for c in texts.column("cells")]
        others = own.filter(pc.is_null(own.column("cells"))).select(given)
        found = make(documents, np.concatenate(cells), dictionary, others)
        give_back()
        return found

    texts = table.where("kind = 'texts'")
    texts = texts.select("block", "docs", "cells", *[F.lit(None).cast("binary").alias(c) for c in given])
    if more is not None:
        none = F.lit(None).cast(table.schema["docs"].dataType).alias("docs")
        texts = texts.union(more.select("block", none, F.lit(None).cast("binary").alias("cells"), *given))
    return texts.groupBy("block").cogroup(values.groupBy("block")).applyInArrow(of_block, schema)


def edges(counts: np.ndarray) -> np.ndarray:
    """0 and the running sums."""
    return np.concatenate([np.zeros(1, np.int64), np.cumsum(counts)])
