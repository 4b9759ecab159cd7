"""BPE encoding and decoding through a table of distinct words.

Texts are split into words (the pieces that the tokenizer merges within; an added special string is one
word), each distinct word of the corpus is encoded once, and its ids go back to the places
of the word (``blocks``). Decoding joins the distinct ids of each block with the table of ids
and pieces, which has one row for each id of the vocabulary file and so a proven size, and
puts the pieces together in the order of the ids.

Null and empty texts have no ids and decode to the empty text. Ids without a piece (also null) decode to
nothing, bytes that are no UTF-8 to U+FFFD, as the library does. Rows are independent: repeated rows
and ids give repeated results. Columns to keep come back in the struct ``row``, so no name can clash.
"""

from __future__ import annotations

import array
import functools
import os
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dqloom.functions.text import quoted
from dqloom.llm import blocks, tokens

AT_ONCE = 20_000
LONG = 4_000_000


@functools.lru_cache(maxsize=2)
def library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def words_of(path: str):
    """A function from a text to its words, in lists."""
    special = tokens.vocabulary(path)[1]

    def lists(text: str) -> Iterator[list[str]]:
        if len(text) < LONG:
            yield tokens.pieces(text)
            return
        pattern = tokens.FULL if tokens.NOT_LATIN.search(text) else tokens.LATIN
        found = (m.group() for m in pattern.finditer(text))
        while some := list(islice(found, AT_ONCE)):
            yield some

    def of(text: str | None) -> Iterator[list[str]]:
        text = text or ""
        at = 0
        for match in special.finditer(text) if special else ():
            yield from lists(text[at : match.start()])
            yield [match.group()]
            at = match.end()
        yield from lists(text[at:])

    return of


def encoder(path: str):
    """A function from words to their ids as little-endian unsigned 32-bit integers."""
    tokenizer = library(path)

    def ids(words: list[str]) -> list[bytes]:
        parts = (words[i : i + AT_ONCE] for i in range(0, len(words), AT_ONCE))
        codes = (tokenizer.encode_batch_fast(some, add_special_tokens=False) for some in parts)
        return [array.array("I", code.ids).tobytes() for code in chain.from_iterable(codes)]

    return ids


def id_pieces(spark: SparkSession, path: str) -> DataFrame:
    """(id, piece): the bytes of every id of the vocabulary file."""
    byte_of = {letter: b for b, letter in enumerate(tokens.byte_letters())}

    def piece(token: str) -> bytearray:
        if all(letter in byte_of for letter in token):
            return bytearray(byte_of[letter] for letter in token)
        return bytearray(token.encode())

    vocabulary = library(path).get_vocab(with_added_tokens=True)
    return spark.createDataFrame([(i, piece(t)) for t, i in vocabulary.items()], "id int, piece binary")


def _ids_of(values: DataFrame) -> DataFrame:
    """(block, id) of the ids in a block's rows of values, each once; the shuffle by block is the one of ``by_block``."""

    def distinct(rows: pa.Table) -> pa.Table:
        parts = (np.unique(np.frombuffer(blocks.restored([x]), np.uint32)) for x in rows.column("data").to_pylist())
        found = np.unique(np.concatenate(list(parts))).astype(np.int32)
        return pa.table({"block": pa.array(np.full(len(found), rows.column("block")[0].as_py())), "id": pa.array(found)})

    return values.groupBy("block").applyInArrow(distinct, "block long, id int")


def _pieces_of(spark: SparkSession, wanted: DataFrame, path: str) -> DataFrame:
    """The id-to-piece join: rows of values with the pieces of (block, number, id)."""
    joined = wanted.join(F.broadcast(id_pieces(spark, path)), "id")
    return blocks.gathered(joined.select("block", "number", "piece"), 1)


def _texts(pieces: blocks.Values, numbers: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Texts of documents whose pieces have these numbers, up to each end."""
    data, sizes = pieces.of(numbers)
    at = blocks.edges(sizes)[np.concatenate([[0], ends])].tolist()
    return pa.array([data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(at, at[1:])], pa.string())


def _of_blocks(docs: DataFrame, path: str, keep: list[str], decoded: bool) -> DataFrame:
    table = blocks.in_blocks(docs, "text", keep, words_of(path))
    values = blocks.worked_out(table, functools.partial(encoder, path), "word-ids")
    pieces = None
    if decoded:
        ids = _ids_of(values).select("block", F.col("id").alias("number"), "id")
        pieces = _pieces_of(docs.sparkSession, ids, path)

    def make(own: pa.Table, words: np.ndarray, dictionary: pa.Table, listed: pa.Table) -> pa.Table:
        ids, sizes = blocks.Values(dictionary).of(words, 4)
        ends = blocks.edges(sizes)[np.cumsum(own.column("n_words").to_numpy())]
        columns = {"row": own.column("row"), "ids": blocks.binary_column(ids.view(np.uint8), 4 * ends)}
        if decoded:
            columns["decoded"] = _texts(blocks.Values(listed), ids, ends)
        return pa.table(columns)

    schema = StructType().add("row", docs.select(*map(quoted, keep)).schema, True)
    schema = StructType(schema.fields + StructType.fromDDL("ids binary" + ", decoded string" * decoded).fields)
    return blocks.by_block(table, values, make, schema, pieces)


def encode(docs: DataFrame, path: str, keep: list[str]) -> DataFrame:
    """``row`` and ``ids`` (little-endian unsigned 32-bit integers) of every text."""
    return _of_blocks(docs, path, keep, False)


def encode_and_decode(docs: DataFrame, path: str, keep: list[str]) -> DataFrame:
    """``row``, ``ids`` and the text that these ids decode to, with blocks read once for both."""
    return _of_blocks(docs, path, keep, True)


def decode(encoded: DataFrame, path: str, keep: list[str]) -> DataFrame:
    """``row`` and the text ``decoded`` of rows with ``ids``."""

    def of(ids: bytes | None) -> Iterator[list[str]]:
        yield [str(i) for i in np.frombuffer(ids or b"", np.uint32).tolist()]

    table = blocks.in_blocks(encoded, "ids", keep, of)
    listed = table.where("kind = 'words'").select("block", "first", F.posexplode("words").alias("at", "id"))
    number = (F.col("first") + F.col("at")).alias("number")
    wanted = listed.select("block", number, F.col("id").cast("int").alias("id"))
    pieces = _pieces_of(encoded.sparkSession, wanted, path)

    def make(own: pa.Table, numbers: np.ndarray, dictionary: pa.Table, _: pa.Table) -> pa.Table:
        known = blocks.Values(dictionary)
        missing = int(numbers.max(initial=-1)) + 1 - len(known.size)
        known.start, known.size = (np.pad(x, (0, max(0, missing))) for x in (known.start, known.size))
        texts = _texts(known, numbers, np.cumsum(own.column("n_words").to_numpy()))
        return pa.table({"row": own.column("row"), "decoded": texts})

    schema = StructType().add("row", encoded.select(*map(quoted, keep)).schema, True).add("decoded", "string")
    return blocks.by_block(table, pieces, make, schema)
