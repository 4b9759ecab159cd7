"""What the operators of this package share: shipped code, cut lineage, Arrow passes, hashes."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
import weakref
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dqloom.functions.text import quoted
from dqloom.sources.snapshots import shared_folder

PACKAGE = Path(__file__).resolve().parents[1]
#: Settings while ``cut`` writes. Arrow batches are bounded in bytes, as each task holds one of texts twice or more.
WRITING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 * 2**20),
}
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application (``addPyFile``)."""
    context: SparkContext = spark.sparkContext
    if getattr(context, "_dqloom_shipped", False):
        return
    archive = Path(tempfile.mkdtemp()) / f"{PACKAGE.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(PACKAGE.rglob("*.py")):
            out.write(path, path.relative_to(PACKAGE.parent))
    context.addPyFile(str(archive))
    context._dqloom_shipped = True


def _folder(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only for a local master that names none."""
    context = spark.sparkContext
    unset = None
    if context.master.split("[")[0] == "local":
        unset = getattr(context, "_dqloom_scratch", None) or tempfile.mkdtemp()
        context._dqloom_scratch = unset
    return shared_folder(spark, unset)


def cut(frame: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write a frame to the shared folder and read it back: a lost executor repeats no more.

    The shuffle files behind it can go once it is written, and the table itself goes when the
    application ends. ``by`` is a column whose values get folders of their own, for ``drop``.
    """
    spark = frame.sparkSession
    path = f"{_folder(spark)}/{name}-{uuid.uuid4().hex}"
    before = {key: spark.conf.get(key, None) for key in WRITING}
    for key, value in WRITING.items():
        spark.conf.set(key, value)
    try:
        writer = frame.write.option("compression", "zstd")
        (writer.partitionBy(by) if by else writer).parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    table = spark.read.schema(frame.schema).parquet(path)
    table._dqloom_place = place
    return table


def drop(table: DataFrame, part: str = "") -> None:
    """Remove a table made by ``cut`` that nothing reads any more, or one folder of it."""
    place = table._dqloom_place
    context = table.sparkSession.sparkContext
    if part:
        place = context._jvm.org.apache.hadoop.fs.Path(place, part)
    place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


def give_back() -> None:
    """Return what a task's arrays took, so that a worker that lives on holds no more than its indexes."""
    for hashes in list(_HASHES):
        hashes.shrink()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def arrow_pass(
    frame: DataFrame, make: Callable[[pa.RecordBatch], Iterator[dict[str, pa.Array]]],
    schema: str | StructType,
) -> DataFrame:
    """Run ``make`` over Arrow batches in tasks; it yields columns of the given schema."""
    ship(frame.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in batches:
                if batch.num_rows:
                    for columns in make(batch):
                        yield pa.RecordBatch.from_pydict(columns)
        finally:
            give_back()

    return frame.mapInArrow(run, schema)


def carrying(frame: DataFrame, carried: list[str], ddl: str) -> StructType:
    """Schema of carried columns of a frame, then those of a DDL text."""
    return StructType([frame.schema[c] for c in carried] + StructType.fromDDL(ddl).fields)


def in_rows(docs: DataFrame) -> DataFrame:
    """``text`` and all columns as the one column ``row``, so that added columns can't clash."""
    return docs.select("text", F.struct(*[docs[quoted(c)] for c in docs.columns]).alias("row"))


def texts_of(column: pa.Array) -> list[str]:
    """Texts of an Arrow column, null as empty."""
    return [text or "" for text in column.to_pylist()]


def slices(lengths: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of rows whose lengths add up to about ``most`` (one row at least)."""
    start, total = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if total and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(lengths):
        yield start, len(lengths)


# --- hashes of all substrings of a buffer --------------------------------------------------

_HASHES: weakref.WeakSet = weakref.WeakSet()
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every bit depends on all (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class RangeHash:
    """Polynomial hashes modulo 2**64 of any byte range of a buffer (``longest`` is a first guess).

    A byte's value comes from a random table, positions are cancelled by the inverse power,
    and the result is mixed. Equal bytes give equal values at any place and in any task.
    """

    def __init__(self, longest: int, seed: int = 1) -> None:
        random = np.random.default_rng(seed)
        base = int(random.integers(1 << 62, 1 << 63)) | 1
        back = pow(base, -1, 1 << 64)
        self.table = random.integers(1, 1 << 63, 256, dtype=np.int64).astype(np.uint64)
        self.bases = base, back
        self.longest, self.usual = 0, longest
        self._reach(longest)
        _HASHES.add(self)

    def shrink(self) -> None:
        """Forget the tables of a text that was longer than usual."""
        if self.longest > self.usual:
            self.longest = 0
            self._reach(self.usual)

    def _reach(self, n: int) -> None:
        if n > self.longest:
            self.longest = n
            self.power, self.inverse = (self._powers(b, n + 1) for b in self.bases)

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            full = np.full(n, np.uint64(base))
            full[0] = 1
            return np.multiply.accumulate(full)

    def prefixes(self, data: np.ndarray) -> np.ndarray:
        """Running sums over the bytes; one more than bytes."""
        self._reach(len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.table[data] * self.power[: len(data)], out=sums[1:])
        return sums

    def of(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of the bytes of every range."""
        return mix((sums[end] - sums[start]) * self.inverse[start] + (end - start).astype(np.uint64) * _ODD)

    def rolling(self, sums: np.ndarray, width: int) -> np.ndarray:
        """Hash of every range of one width."""
        n = len(sums) - width
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((sums[width:] - sums[:n]) * self.inverse[:n])
