"""Packing: best-fit decreasing with a segment tree over remaining capacities.

Texts become ids, each document ends with one end id. Overlong documents are first cut into full
windows; what is left of each is placed, longest first, into the open window with the least
remaining room that still takes it. The segment tree is indexed by remaining capacity and holds how
many open windows have it, so the tightest one is found in one walk. Windows are packed within the
rows of a task, in groups of ``GROUP_IDS`` ids, so nothing is shuffled and memory is bounded.

After placing, windows filled to less than ``FULL`` are opened again: their pieces, longest first,
are cut to fill them one after the other; the last one is closed in lengths that are powers of two,
which need no padding, and what would be shorter than ``LEAST`` goes where good windows have room left.
So padding stays small for any mix of lengths.

Null and empty texts are one end id. Every id lies in exactly one piece. Sequence numbers are unique
over the table (task number and a count within it). Repeated rows are packed each for itself;
further columns of the input are ignored.
"""

from __future__ import annotations

import functools
import itertools
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from dqloom.llm.common import give_back, ship, slices, texts_of
from dqloom.llm.tokens import byte_letters, pieces

GROUP_IDS = 4_000_000
FULL = 0.97
LEAST = 64
REMEMBERED = 1_000_000
SCHEMA = (
    "start long, length long, ids array<int>, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, sequence_length long"
)


class CapacityTree:
    """Segment tree over capacities 0..most: open windows by how much room they have left."""

    def __init__(self, most: int) -> None:
        self.base = 1 << most.bit_length()
        self.count = [0] * (2 * self.base)
        self.windows: dict[int, list[int]] = defaultdict(list)

    def _add(self, room: int, by: int) -> None:
        node = self.base + room
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, room: int, window: int) -> None:
        self.windows[room].append(window)
        self._add(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """Room and number of the tightest window with room for ``need``, taken out of the tree."""
        node = self.base + need
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.base:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.base
        self._add(room, -1)
        return room, self.windows[room].pop()


Piece = tuple[int, int, int]  # row, start, length


def best_fit(items: list[Piece], most: int) -> list[list[Piece]]:
    """Windows of pieces, by best fit in order of falling length."""
    tree, windows = CapacityTree(most), []
    for item in sorted(items, key=lambda x: (-x[2], x[0])):
        found = tree.take(item[2])
        if found is None:
            room, window = most, len(windows)
            windows.append([])
        else:
            room, window = found
        windows[window].append(item)
        if room > item[2]:
            tree.put(room - item[2], window)
    return windows


def _closing(n: int, most: int) -> list[int]:
    """Lengths that a rest is closed in: itself if nearly full, else powers of two."""
    if n >= FULL * most:
        return [n]
    return [1 << b for b in reversed(range(n.bit_length())) if n >> b & 1]


def fill_up(loose: list[Piece], good: list[list[Piece]], most: int) -> list[list[Piece]]:
    """All windows, with the loose pieces cut, in order, to fill windows of their own.

    What would close in less than ``LEAST`` ids tops up the room that good windows have left.
    """
    total = sum(p[2] for p in loose)
    rooms = [[[], most] for _ in range(total // most)]
    closing = _closing(total % most, most)
    rooms += [[[], length] for length in closing if length >= LEAST]
    left = sum(length for length in closing if length < LEAST)
    for window in good:
        room = min(left, most - sum(p[2] for p in window))
        if room:
            rooms.append([window, room])
            left -= room
    rooms += [[[], length] for length in _closing(left, most)]
    source = iter(loose)
    row, start, length = next(source, (0, 0, 0))
    for window, room in rooms:
        while room:
            if not length:
                row, start, length = next(source)
            used = min(room, length)
            window.append((row, start, used))
            start, length, room = start + used, length - used, room - used
    return [window for window, _ in rooms]


def pack_lengths(lengths: list[int], most: int) -> list[list[Piece]]:
    """Sequences of pieces for documents of these lengths."""
    whole, rest = [], []
    for row, n in enumerate(lengths):
        whole += [[(row, s, most)] for s in range(0, n - most + 1, most)]
        if n % most:
            rest.append((row, n - n % most, n % most))
    packed = best_fit(rest, most)
    good = [w for w in packed if sum(p[2] for p in w) >= FULL * most]
    loose = [p for w in packed if sum(p[2] for p in w) < FULL * most for p in w]
    loose.sort(key=lambda x: (-x[2], x[0]))
    added = fill_up(loose, good, most)
    topped = {id(w) for w in good}
    return whole + good + [w for w in added if id(w) not in topped]


class PieceCodes(dict):
    """Ids of pieces as bytes, asked of the tokenizer's model when first met."""

    def __init__(self, model) -> None:
        super().__init__()
        self.model, self.letters = model, dict(enumerate(byte_letters()))

    def __missing__(self, piece: str) -> bytes:
        letters = piece.encode().decode("latin-1").translate(self.letters)
        code = array("I", [token.id for token in self.model.tokenize(letters)]).tobytes()
        if len(self) >= REMEMBERED:
            self.clear()
        self[piece] = code
        return code


class PieceIds:
    """Ids of texts by a tokenizer file, remembered by piece."""

    def __init__(self, path: str) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known = PieceCodes(self.tokenizer.model)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = [t for t in added if t]

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        code = self.known.__getitem__
        out = []
        for text in texts:
            if any(t in text for t in self.special):
                out.append(np.array(self._library([text])[0].ids, np.uint32))
            else:
                out.append(np.frombuffer(b"".join(map(code, pieces(text))), np.uint32))
        return out

    def _library(self, texts: list[str]):
        return self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)


@functools.lru_cache(maxsize=2)
def ids_by(path: str) -> PieceIds:
    return PieceIds(path)


def pack_documents(
    docs: DataFrame, path: str, most: int = 2048, end_id: int = 1, id_column: str = "doc_id", remember: bool = True
) -> DataFrame:
    """Pieces of all documents with their place in sequences of at most ``most`` ids.

    With ``remember`` a worker keeps the ids of the pieces it has met for its next task; without, it gives
    them and the tokenizer back when a task ends, as befits one of many stages.
    """
    ship(docs.sparkSession)
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        number = itertools.count((context.partitionId() if context else 0) << 36)
        encode, end = ids_by(path), np.array([end_id], np.uint32)
        names: list = []
        ids: list[np.ndarray] = []
        held = 0

        def packed() -> Iterator[pa.RecordBatch]:
            rows = []
            for window in pack_lengths([len(x) for x in ids], most):
                sequence, offset = next(number), 0
                length = sum(p[2] for p in window)
                for row, start, n in window:
                    rows.append((row, start, n, sequence, offset, length))
                    offset += n
            for i in range(0, len(rows), 2000):
                part = rows[i : i + 2000]
                codes = [ids[r][s : s + n] for r, s, n, *_ in part]
                flat = np.concatenate(codes).astype(np.int32)
                places = np.cumsum([0, *map(len, codes)]).astype(np.int32)
                numbers = [pa.array(x, pa.int64()) for x in zip(*(x[1:] for x in part))]
                start, length, sequence, offset, total = numbers
                yield pa.RecordBatch.from_pydict({
                    id_column: pa.array([names[x[0]] for x in part], names_type),
                    "start": start,
                    "length": length,
                    "ids": pa.ListArray.from_arrays(places, flat),
                    "ids_crc32": pa.array([zlib.crc32(c.astype("<u4").tobytes()) for c in codes], pa.int64()),
                    "doc_tokens": pa.array([len(ids[x[0]]) for x in part], pa.int64()),
                    "sequence_id": sequence,
                    "offset": offset,
                    "sequence_length": total,
                })
            names.clear()
            ids.clear()

        names_type = None
        for batch in batches:
            names_type = batch.column(0).type
            texts = texts_of(batch.column(1))
            for a, b in slices(np.array([len(t) for t in texts]), 2_000_000):
                for name, codes in zip(batch.column(0)[a:b].to_pylist(), encode(texts[a:b])):
                    names.append(name)
                    ids.append(np.concatenate([codes, end]))
                    held += len(ids[-1])
                if held >= GROUP_IDS:
                    yield from packed()
                    held = 0
        if ids:
            yield from packed()
        if not remember:
            ids_by.cache_clear()
            del encode
            give_back()

    return docs.select(id_column, "text").mapInArrow(run, f"`{id_column}` {kind}, {SCHEMA}")
