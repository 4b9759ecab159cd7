"""Removal of repeated byte strings, by prefix-free parsing.

Every byte is removed that is covered by a string of ``LENGTH`` bytes that also starts in a document with a
smaller id. Strings are judged on the input; matches never cross documents.

The corpus is parsed into phrases: a phrase ends where a rolling hash triggers, so equal text is cut at equal
places. A phrase is taken with the ``LENGTH - 1`` bytes that follow, so every string lies in one phrase. Equal
phrases form the dictionary; where a phrase was first seen in a smaller document, all its strings are repeats at
once, and only first occurrences are looked at further. That is what makes highly repetitive text cheap.

In the dictionary, suffixes are put in order as far as the question needs it, by their first ``LENGTH`` bytes.
No task may hold the dictionary's suffix array whole, so its equal runs are found by key instead: strings share
the smallest hash of their ``GRAM``-byte pieces (their anchor), and only strings whose anchor occurs in two
texts can be equal. Texts are worked on in bundles of about ``BUNDLE`` bytes, anchors in slices. A bundle tells each
slice its anchors, each once and many in a row, and a slice answers which are shared. The runs of strings with a
shared anchor (blocks) then go to the anchor's slice with their bytes, one of equal blocks a bundle: blocks are
compared as a whole, and strings one by one where an anchor has several blocks. All comparisons are of 128-bit
hashes, and both numbers grow with the text, so that no task holds more than a share.

Null texts are empty. Documents without id are returned whole and are nobody's original. Rows with equal ids
never remove from one another. Texts shorter than ``LENGTH`` bytes stay whole. Further columns are kept in
``row``. Empty tables give no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqloom.llm.common import RangeHash, arrow_pass, carrying, cut, drop, give_back, in_rows, ship, slices
from dqloom.operators.keyed import spread_left_join

LENGTH = 50
GRAM = 26
TRIGGER_WIDTH, TRIGGER_MASK = 8, 255  # phrases of 256 bytes on average
HELD = 400_000  # bytes worked on at a time
BUNDLE, SLICE = 2_000_000, 13_000_000  # bytes of text in a bundle, and those that a slice of the anchors stands for
RESULT = "kept binary, n_bytes long, n_removed long, spans array<struct<first:long,last:long>>"


@functools.lru_cache(maxsize=1)
def _hashes() -> tuple[RangeHash, RangeHash]:
    return RangeHash(HELD, 11), RangeHash(HELD, 12)


class Buffer:
    """Texts end to end, with the running sums of two hashes."""

    def __init__(self, texts: list[bytes], second: bool = True) -> None:
        self._fill(np.frombuffer(b"".join(texts), np.uint8), np.array([len(t) for t in texts], np.int64), second)

    @classmethod
    def over(cls, data: np.ndarray, lengths: np.ndarray, second: bool = True) -> Buffer:
        """A buffer of bytes that lie end to end already."""
        buffer = cls.__new__(cls)
        buffer._fill(data, lengths, second)
        return buffer

    def _fill(self, data: np.ndarray, lengths: np.ndarray, second: bool) -> None:
        self.data = data
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths
        self.hash, self.other = _hashes()
        self.sums = self.hash.prefixes(self.data)
        self.other_sums = self.other.prefixes(self.data) if second else None

    def both(self, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        one = self.hash.of(self.sums, start, end)
        two = self.other.of(self.other_sums, start, end)
        return one.view(np.int64), two.view(np.int64)


def phrase_bounds(buffer: Buffer) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, start and end (what follows included) of all phrases that hold a string."""
    trigger = buffer.hash.rolling(buffer.sums, TRIGGER_WIDTH)
    at = np.flatnonzero((trigger & np.uint64(TRIGGER_MASK)) == 0)
    owner = np.searchsorted(buffer.ends, at, "right")
    at, owner = at[owner < len(buffer.ends)], owner[owner < len(buffer.ends)]
    inside = at + TRIGGER_WIDTH < buffer.ends[owner]
    full = np.flatnonzero(buffer.ends > buffer.starts)
    start = np.concatenate([buffer.starts[full], at[inside] + TRIGGER_WIDTH])
    owner = np.concatenate([full, owner[inside]])
    order = np.argsort(start, kind="stable")
    start, owner = start[order], owner[order]
    following = np.append(start[1:], len(buffer.data))
    end = np.minimum(following + LENGTH - 1, buffer.ends[owner])
    long = end - start >= LENGTH
    return owner[long], start[long], end[long]


def anchors(buffer: Buffer, marked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, number (up to the width of the choice) and anchor of runs of marked strings that share an anchor."""
    pieces = buffer.hash.rolling(buffer.sums, GRAM)
    width, least = 1, pieces
    span = LENGTH - GRAM + 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
    at = np.flatnonzero(marked[: len(least)])
    if not len(at):
        return at, at, least[:0]
    value = least[at]
    new = np.append(True, (value[1:] != value[:-1]) | (at[1:] != at[:-1] + 1))
    offset = np.arange(len(at)) - np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
    first = np.flatnonzero(offset % span == 0)  # periodic text would make runs of any length
    return at[first], np.diff(np.append(first, len(at))), value[first]


def _bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column end to end, and the length of each value; null is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    held = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(held):
        return np.zeros(0, np.uint8), np.zeros(0, np.int64)
    ends = np.frombuffer(held.buffers()[1], np.int64)[held.offset : held.offset + len(held) + 1]
    return np.frombuffer(held.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]], np.diff(ends)


def _windows(data: np.ndarray, lengths: np.ndarray, second: bool = True) -> Iterator[tuple[int, int, Buffer]]:
    """Buffers of bounded bytes: first value, end and buffer."""
    ends = np.cumsum(lengths)
    for a, b in slices(lengths, HELD):
        yield a, b, Buffer.over(data[ends[a] - lengths[a] : ends[b - 1]], lengths[a:b], second)


def _within(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... anew for every group of the given size."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Sizes of a column's lists, and all their elements; null is empty."""
    lists = column.combine_chunks()
    if not len(lists):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    counts = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    return counts, lists.flatten().to_numpy(zero_copy_only=False)


def _lists(counts: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)).astype(np.int32)), pa.array(values))


def parse(base: DataFrame) -> DataFrame:
    """All phrases: rid, doc_id, start, end, two hashes."""

    def make(batch):
        for a, b, buffer in _windows(*_bytes(batch.column("text"))):
            owner, start, end = phrase_bounds(buffer)
            one, two = buffer.both(start, end)
            local = buffer.starts[owner]
            take = pa.array(a + owner)
            yield {
                "rid": batch.column("rid").take(take), "doc_id": batch.column("doc_id").take(take),
                "start": pa.array((start - local).astype(np.int32)), "end": pa.array((end - local).astype(np.int32)),
                "h1": pa.array(one), "h2": pa.array(two),
            }

    return arrow_pass(base, make, "rid long, doc_id long, start int, end int, h1 long, h2 long")


def _least(doc: np.ndarray, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of every value the smallest document that has an equal one, and the number of its class."""
    if not len(doc):
        return doc, np.zeros(0, np.int64)
    order = np.argsort(one, kind="stable")
    if ((np.diff(one[order]) == 0) & (np.diff(two[order]) != 0)).any():
        order = np.lexsort((two, one))
    new = np.append(True, (np.diff(one[order]) != 0) | (np.diff(two[order]) != 0))
    least, number = np.empty_like(doc), np.empty(len(doc), np.int64)
    number[order] = np.cumsum(new) - 1
    least = np.minimum.reduceat(doc[order], np.flatnonzero(new))[number]
    return least, number


def _runs(texts: pa.Table, firsts: pa.Table, second: bool) -> Iterator[tuple]:
    """Of a bundle, the runs of strings by anchor over the phrases that were first seen here, window by window.

    Each window is the table of its texts, its buffer, and of every run the row, start, number and anchor. Anchors lose
    their lowest bit. Rows that share id and text are taken once.
    """
    if not texts.num_rows or not firsts.num_rows:
        return
    rid, at = np.unique(texts["rid"].to_numpy(), return_index=True)
    counts, lo = _flat(firsts["starts"])
    _, hi = _flat(firsts["ends"])
    _, i, j = np.intersect1d(rid, firsts["rid"].to_numpy(), assume_unique=True, return_indices=True)
    texts = texts.take(pa.array(at[i]))
    before, held = (np.cumsum(counts) - counts)[j], counts[j]
    for a, b, buffer in _windows(*_bytes(texts["text"]), second):
        n = held[a:b]
        which = np.repeat(before[a:b], n) + _within(n)
        place, size = np.repeat(buffer.starts, n), len(buffer.data) + 2
        step = np.bincount(place + lo[which], minlength=size) - np.bincount(place + hi[which] - LENGTH + 1, minlength=size)
        start, count, value = anchors(buffer, np.cumsum(step)[: len(buffer.data)] > 0)
        row = np.searchsorted(buffer.ends, start, "right")
        yield texts.slice(a, b - a), buffer, row, start, count, value.view(np.int64) & -2


def _slice_of(anchor: np.ndarray, number: int) -> np.ndarray:
    return (anchor >> 1 & 0x7FFFFFFF) % number  # minima are small, but their low bits are not


def _joined(parts: list[np.ndarray], kind: type = np.int64) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def _anchors_by_slice(texts: pa.Table, firsts: pa.Table, slice_count: int) -> pa.Table:
    """The anchors of a bundle, each once. Its lowest bit says that several texts of the bundle have it."""
    rows, values, seen = [], [], 0
    for own, _, row, _, _, value in _runs(texts, firsts, second=False):
        rows.append(seen + row)
        values.append(value)
        seen += own.num_rows
    row, value = _joined(rows), _joined(values)
    order = np.argsort(value, kind="stable")
    row, value = row[order], value[order]
    new = np.flatnonzero(np.append(True, np.diff(value) != 0)) if len(value) else order
    last = np.append(new[1:], len(value)) - 1 if len(value) else order
    several = row[new] != row[last]
    value = value[new]
    dealt = _slice_of(value, slice_count)
    order = np.argsort(dealt, kind="stable")
    counts = np.bincount(dealt, minlength=slice_count)
    used = np.flatnonzero(counts)
    bundle = texts["bundle"][0].as_py() if texts.num_rows else 0
    return pa.table({
        "slice": pa.array(used.astype(np.int32)), "bundle": pa.array(np.full(len(used), bundle, np.int32)),
        "anchors": _lists(counts[used], (value | several)[order]),
    })


def _shared(rows: pa.Table) -> pa.Table:
    """Of every bundle's anchors in a slice, those that several texts have."""
    counts, value = _flat(rows["anchors"])
    owner = np.repeat(np.arange(len(counts)), counts)
    order = np.argsort(value & -2, kind="stable")
    held = value[order]
    new = np.append(True, np.diff(held & -2) != 0)
    group, first = np.cumsum(new) - 1, np.flatnonzero(new)
    size = np.diff(np.append(first, len(held)))
    wanted = np.empty(len(value), bool)
    wanted[order] = ((size > 1) | (np.maximum.reduceat(held & 1, first) > 0))[group]
    left = np.bincount(owner[wanted], minlength=len(counts))
    some = np.flatnonzero(left)
    return pa.table({
        "bundle": rows["bundle"].combine_chunks().take(pa.array(some)),
        "anchors": _lists(left[some], value[wanted] & -2),
    })


def _blocks_by_slice(texts: pa.Table, news: pa.Table, slice_count: int) -> pa.Table:
    """The blocks of a bundle whose anchor is shared: their bytes where the block's first document in the bundle has them."""
    own = pc.is_valid(news["rid"])
    _, shared = _flat(news.filter(pc.invert(own))["anchors"])
    shared = np.sort(shared)
    found: list[list[np.ndarray]] = [[] for _ in range(8)]
    pieces = []
    if len(shared):
        for held, buffer, row, start, count, value in _runs(texts, news.filter(own), second=True):
            near = np.minimum(np.searchsorted(shared, value), len(shared) - 1)
            here = shared[near] == value
            row, start, count, value = row[here], start[here], count[here], value[here]
            one, two = buffer.both(start, start + count + LENGTH - 1)
            fields = (held["rid"].to_numpy()[row], held["doc_id"].to_numpy()[row], start - buffer.starts[row], count, value, one, two,
                      start + sum(map(len, pieces)))
            for kept, x in zip(found, fields):
                kept.append(x)
            pieces.append(buffer.data)
    rid, doc, at, n, anchor, one, two, start = map(_joined, found)
    data = _joined(pieces, np.uint8)
    first = _least(doc, one, two)[0] == doc
    dealt = _slice_of(anchor, slice_count)
    order = np.argsort(dealt, kind="stable")
    counts = np.bincount(dealt, minlength=slice_count)
    used = np.flatnonzero(counts)
    sizes = np.where(first, n + LENGTH - 1, 0)[order]
    taken = data[np.repeat(start[order], sizes) + _within(sizes)].tobytes()
    cuts = np.append(0, np.cumsum(np.bincount(dealt[order], sizes, slice_count)[used])).astype(np.int32)
    bundle = texts["bundle"][0].as_py() if texts.num_rows else 0
    lists = {"rid": rid, "doc_id": doc, "at": at.astype(np.int32), "n": n.astype(np.int32), "anchor": anchor, "first": first}
    return pa.table({
        "slice": pa.array(used.astype(np.int32)), "bundle": pa.array(np.full(len(used), bundle, np.int32)),
        **{name: _lists(counts[used], x[order]) for name, x in lists.items()},
        "bytes": pa.Array.from_buffers(pa.binary(), len(used), [None, pa.py_buffer(cuts), pa.py_buffer(taken)]),
    })


def _repeats(rows: pa.Table) -> pa.Table:
    """Of every bundle's blocks in a slice, the stretches that a smaller document has."""
    counts, rid = _flat(rows["rid"])
    doc, at, n, anchor, first = (_flat(rows[c])[1] for c in ("doc_id", "at", "n", "anchor", "first"))
    owner = np.repeat(np.arange(len(counts)), counts)
    data, _ = _bytes(rows["bytes"])
    heads = np.flatnonzero(first)
    lengths = n[heads].astype(np.int64) + LENGTH - 1
    hashes = [b.both(b.starts, b.ends) for _, _, b in _windows(data, lengths)]
    one, two = (_joined([h[k] for h in hashes]) for k in (0, 1))
    least, kind = _least(doc[heads], one, two)
    again = ~first
    again[heads] = least < doc[heads]
    whole = np.flatnonzero(again)
    marks = [(whole, at[whole], at[whole] + n[whole] + LENGTH - 1)]
    # strings are looked at one by one where an anchor has several blocks
    left = np.flatnonzero(least == doc[heads])
    order = left[np.lexsort((kind[left], anchor[heads][left]))]
    value, number = anchor[heads][order], kind[order]
    new = np.append(True, np.diff(value) != 0)[: len(value)]
    group = np.cumsum(new) - 1
    several = np.bincount(group[1:][(np.diff(number) != 0) & ~new[1:]], minlength=len(value) + 1)[group] > 0
    left = np.sort(order[several])
    if len(left):
        ends = np.cumsum(lengths)
        sizes = lengths[left]
        data = data[np.repeat(ends[left] - sizes, sizes) + _within(sizes)]
        ones, twos = [], []
        for a, b, buffer in _windows(data, sizes):
            number = sizes[a:b] - LENGTH + 1
            start = np.repeat(buffer.starts, number) + _within(number)
            one, two = buffer.both(start, start + LENGTH)
            ones.append(one)
            twos.append(two)
        number = sizes - LENGTH + 1
        block, offset = np.repeat(heads[left], number), _within(number)
        found = np.flatnonzero(_least(doc[block], _joined(ones), _joined(twos))[0] < doc[block])
        block, offset = block[found], offset[found]
        new = np.append(True, (np.diff(block) != 0) | (np.diff(offset) != 1))[: len(block)]
        last = np.append(new[1:], True)[: len(block)]
        marks.append((block[new], at[block[new]] + offset[new], at[block[new]] + offset[last] + LENGTH))
    place, start, end = (_joined([m[k] for m in marks]) for k in range(3))
    order = np.argsort(owner[place], kind="stable")
    place = place[order]
    of = np.bincount(owner[place], minlength=len(counts))
    some = np.flatnonzero(of)
    return pa.table({
        "bundle": rows["bundle"].combine_chunks().take(pa.array(some)),
        "rids": _lists(of[some], rid[place]),
        "starts": _lists(of[some], start[order].astype(np.int32)), "ends": _lists(of[some], end[order].astype(np.int32)),
    })


def _clearing(make: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """``make`` over groups, after each of which the worker gives back what it took."""

    def run(rows: pa.Table) -> pa.Table:
        try:
            return make(rows)
        finally:
            give_back()

    return run


def _clearing_both(make: Callable[[pa.Table, pa.Table], pa.Table]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The same over pairs of groups."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        try:
            return make(left, right)
        finally:
            give_back()

    return run


def find_repeats(base: DataFrame) -> tuple[DataFrame, int]:
    """Marked ranges (first byte, end excluded) as lists by bundle, and the number of bundles.

    A bundle is what ``rid`` leaves; a slice of the anchors and of their blocks is what an anchor leaves.
    """
    spark = base.sparkSession
    ship(spark)
    phrases = cut(parse(base), "phrases")
    total = phrases.agg(F.sum(F.col("end") - F.col("start"))).first()[0] or 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bundle_count, slice_count = max(least, total // BUNDLE), max(least, total // SLICE)
    bundle = F.pmod("rid", F.lit(bundle_count)).cast("int").alias("bundle")
    seen = phrases.groupBy("h1", "h2").agg(F.min("doc_id").alias("least"))
    span = F.struct("start", "end")
    again = F.col("least") < F.col("doc_id")
    parsed = cut(
        # a phrase that very many documents have is met in many tasks
        spread_left_join(phrases, seen, ["h1", "h2"]).groupBy("rid").agg(
            F.collect_list(F.when(again, span)).alias("marks"),
            F.collect_list(F.when(~again, span)).alias("firsts"),
        ),
        "parsed",
    )
    drop(phrases)
    texts = base.select(bundle, "rid", "doc_id", "text").groupBy("bundle")
    news = parsed.where(F.size("firsts") > 0).select(
        bundle, "rid", F.col("firsts.start").alias("starts"), F.col("firsts.end").alias("ends")
    )
    # runs are worked out twice, which takes less than writing, keeping and reading them
    told = texts.cogroup(news.groupBy("bundle")).applyInArrow(
        _clearing_both(lambda t, n: _anchors_by_slice(t, n, slice_count)), "slice int, bundle int, anchors array<long>"
    )
    shared = cut(
        told.groupBy("slice").applyInArrow(_clearing(_shared), "bundle int, anchors array<long>"), "shared-anchors"
    )
    asked = news.unionByName(shared, allowMissingColumns=True)
    blocks = texts.cogroup(asked.groupBy("bundle")).applyInArrow(
        _clearing_both(lambda t, n: _blocks_by_slice(t, n, slice_count)),
        "slice int, bundle int, rid array<long>, doc_id array<long>, at array<int>, n array<int>, anchor array<long>, "
        "first array<boolean>, bytes binary",
    )
    listed = "bundle int, rids array<long>, starts array<int>, ends array<int>"
    found = blocks.groupBy("slice").applyInArrow(_clearing(_repeats), listed)
    old = parsed.where(F.size("marks") > 0).select(
        bundle, F.array_repeat("rid", F.size("marks")).alias("rids"),
        F.col("marks.start").alias("starts"), F.col("marks.end").alias("ends"),
    )
    marks = cut(old.unionByName(found), "marks")
    drop(parsed)
    drop(shared)
    return marks, bundle_count


def _gone(rid: np.ndarray, lengths: np.ndarray, marks: pa.Table) -> np.ndarray:
    """Which bytes of the texts of a bundle are marked."""
    total = int(lengths.sum())
    _, own = _flat(marks["rids"])
    _, lo = _flat(marks["starts"])
    _, hi = _flat(marks["ends"])
    order = np.argsort(own, kind="stable")
    own, lo, hi = own[order], lo[order].astype(np.int64), hi[order].astype(np.int64)
    begin, end = np.searchsorted(own, rid, "left"), np.searchsorted(own, rid, "right")
    which = np.repeat(begin, end - begin) + _within(end - begin)
    place = np.repeat(np.cumsum(lengths) - lengths, end - begin)
    step = np.bincount(place + lo[which], minlength=total + 1) - np.bincount(place + hi[which], minlength=total + 1)
    return np.cumsum(step)[:total] > 0


def _marked(docs: DataFrame, make: Callable[[pa.Table, np.ndarray, np.ndarray, np.ndarray], pa.Table], ddl: str) -> DataFrame:
    """``row`` and what ``make`` adds, from rows, their bytes, lengths and which bytes are marked."""
    rid = F.xxhash64(F.col("row.doc_id").cast("long"), F.col("row.text"))
    rows = in_rows(docs).withColumn("rid", rid)
    whole = F.col("row.doc_id").isNull() | F.coalesce(F.octet_length("text") < LENGTH, F.lit(True))
    base = rows.where(~whole).select("rid", F.col("row.doc_id").cast("long").alias("doc_id"), "text")
    marks, bundle_count = find_repeats(base)
    # rows that stay whole need no marks: copies of one are spread
    place = F.when(whole, F.xxhash64("rid", F.spark_partition_id())).otherwise(F.col("rid"))
    bundle = F.pmod(place, F.lit(bundle_count)).cast("int").alias("bundle")
    kept = rows.select(bundle, F.when(~whole, F.col("rid")).alias("rid"), "row")
    schema = carrying(rows, ["row"], ddl)

    def clear(texts: pa.Table, own: pa.Table) -> pa.Table:
        # a null id has no marks: its bytes are those of an empty list
        some = pc.is_valid(texts["rid"])
        parts = []
        for chosen, marked in ((texts.filter(some), own), (texts.filter(pc.invert(some)), own.slice(0, 0))):
            row = chosen["row"].combine_chunks()
            data, lengths = _bytes(row.field("text"))
            parts.append(make(row, data, lengths, _gone(chosen["rid"].fill_null(0).to_numpy(), lengths, marked)))
        return pa.concat_tables(parts)

    return kept.groupBy("bundle").cogroup(marks.groupBy("bundle")).applyInArrow(_clearing_both(clear), schema)


def _parts(lengths: np.ndarray, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of texts after bytes went, and the offsets that they make."""
    ends = np.append(0, np.cumsum(kept))[np.append(0, np.cumsum(lengths))]
    return np.diff(ends), ends.astype(np.int32)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``row`` with all columns, the bytes kept, their number before, how many went, and the removed runs."""
    pair = [pa.field("first", pa.int64()), pa.field("last", pa.int64())]

    def make(row: pa.StructArray, data: np.ndarray, lengths: np.ndarray, gone: np.ndarray) -> pa.Table:
        left, ends = _parts(lengths, ~gone)
        begins = np.append(0, np.cumsum(lengths))
        edge = np.zeros(len(data) + 1, bool)
        edge[begins] = True  # a run ends with its text
        edge = edge[:-1]
        before, after = np.append(False, gone[:-1])[: len(gone)], np.append(gone[1:], False)[: len(gone)]
        first = np.flatnonzero(gone & (~before | edge))
        last = np.flatnonzero(gone & (~after | np.append(edge[1:], True)[: len(gone)]))
        owner = np.searchsorted(begins, first, "right") - 1
        spans = pa.StructArray.from_arrays([pa.array(x - begins[owner]) for x in (first, last)], fields=pair)
        counts = np.append(0, np.cumsum(np.bincount(owner, minlength=len(lengths)))).astype(np.int32)
        return pa.table({
            "row": row,
            "kept": pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(ends), pa.py_buffer(data[~gone].tobytes())]),
            "n_bytes": pa.array(lengths.astype(np.int64)), "n_removed": pa.array((lengths - left).astype(np.int64)),
            "spans": pa.ListArray.from_arrays(pa.array(counts), spans),
        })

    return _marked(docs, make, RESULT)


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents with all columns, removed bytes gone from ``text``; half characters at cuts go too."""

    def make(row: pa.StructArray, data: np.ndarray, lengths: np.ndarray, gone: np.ndarray) -> pa.Table:
        begins = np.append(0, np.cumsum(lengths))
        left, _ = _parts(lengths, ~gone)
        texts = row.field("text").to_pylist()
        for i in np.flatnonzero(left < lengths):
            here, out = data[begins[i] : begins[i + 1]], gone[begins[i] : begins[i + 1]]
            edges = np.flatnonzero(np.diff(out)) + 1
            pieces = np.split(here, edges)[int(out[0]) :: 2]
            texts[i] = "".join(p.tobytes().decode("utf-8", "ignore") for p in pieces)
        return pa.table({"row": row, "text": pa.array(texts, pa.string())})

    clean = _marked(docs, make, "text string")
    return clean.select(F.col("row").withField("text", F.col("text")).alias("row")).select("row.*")
