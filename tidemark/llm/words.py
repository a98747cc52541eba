"""Words of many texts at once, as numpy arrays over the bytes of an Arrow column.

Operators get their texts through ``mapInArrow``. A text column is a buffer of
bytes with offsets; all word boundaries and hashes of a block of documents come
from a few array operations on it, without a Python string per word. Blocks
hold about ``BLOCK`` bytes (one longer text is a block of its own), so memory
depends on the longest text and not on the size of a batch. Workers live through
many tasks, so what a batch has freed is given back to the machine after it.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

BLOCK = 1 << 18
U64 = np.uint64


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: Everything but ASCII white space, as in [^\x20\x09-\x0D].
SOLID = ~byte_class((0x20, 0x20), (0x09, 0x0D))
#: ASCII digits, ASCII letters and everything beyond ASCII.
ALNUM = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
#: Bytes that begin a code point.
LEADS = ~byte_class((0x80, 0xBF))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_random = np.random.default_rng(20240229)
_BYTE = _random.integers(1, 1 << 63, 256, dtype=U64) * U64(2) + U64(1)
_BASE = U64(0x9E3779B97F4A7C15)
_BASE_INV = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


class Cache(dict):
    """Is empty again after a journey to a worker, which may know nothing of this module."""

    def __reduce__(self):
        return dict, ()


_powers = Cache()


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """The first n powers of the hash base (or of its inverse) modulo 2**64."""
    known = _powers.get(inverse)
    if known is None or len(known) < n:
        steps = np.full(max(n, BLOCK + 1), _BASE_INV if inverse else _BASE, U64)
        steps[0] = 1
        known = np.multiply.accumulate(steps)
        if n <= 4 * BLOCK:  # a huge text does not leave its arrays behind
            _powers[inverse] = known
    return known[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread a polynomial hash over all its bits."""
    h = h ^ (h >> U64(33))
    h *= U64(0xFF51AFD7ED558CCD)
    h ^= h >> U64(29)
    h *= U64(0xC4CEB9FE1A85EC53)
    h ^= h >> U64(32)
    return h


def prefix(values: np.ndarray) -> np.ndarray:
    """Prefix sums of the values' polynomial, one longer than the values."""
    out = np.zeros(len(values) + 1, U64)
    np.cumsum(values * powers(len(values)), out=out[1:])
    return out


def byte_prefix(data: np.ndarray) -> np.ndarray:
    return prefix(_BYTE[data])


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each span that depends on its content only."""
    inverse = powers(len(sums), inverse=True)
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(U64))


class Block:
    """Some documents' bytes: ``data``, and ``offsets`` with one more entry than documents."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first: int):
        self.data, self.offsets, self.first = data, offsets, first

    def __len__(self) -> int:
        return len(self.offsets) - 1

    @property
    def rows(self) -> slice:
        """The block's rows in its batch."""
        return slice(self.first, self.first + len(self))

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()

    def spans(self, inside: np.ndarray, cuts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of maximal runs of marked bytes, and where each document's begin.

        The third array has one more entry than documents. No run crosses a document
        or goes on at one of the positions ``cuts``.
        """
        n = len(self.data)
        if not n:
            empty = np.zeros(0, np.int64)
            return empty, empty, np.zeros(len(self.offsets), np.int64)
        begins, stops = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        stops[:-1] &= ~inside[1:]
        edges = self.offsets[(self.offsets > 0) & (self.offsets < n)]
        if cuts is not None:
            edges = np.concatenate((edges, cuts))
        begins[edges] |= inside[edges]
        stops[edges - 1] |= inside[edges - 1]
        starts = np.flatnonzero(begins)
        return starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, self.offsets)

    def count(self, marked: np.ndarray) -> np.ndarray:
        """Marked bytes per document."""
        return np.diff(np.concatenate(([0], np.cumsum(marked)))[self.offsets])


class Words:
    """The words of a block: starts, ends, hashes; ``of`` says where each document's begin."""

    def __init__(self, block: Block, data: np.ndarray, kind: np.ndarray, cuts: np.ndarray | None = None):
        self.block = block
        self.starts, self.ends, self.of = block.spans(kind[data], cuts)
        self.sums = byte_prefix(data)
        self.hashes = span_hash(self.sums, self.starts, self.ends)

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.of)

    @cached_property
    def doc(self) -> np.ndarray:
        """The document of each word."""
        return np.repeat(np.arange(len(self.block)), self.counts)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """First words and hashes of all n-word windows inside a document."""
        return windows(self.hashes, self.of, n)


def windows(hashes: np.ndarray, of: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First positions and hashes of all windows of n values inside a document."""
    room = np.maximum(np.diff(of) - n + 1, 0)
    first = ragged(of[:-1], room)
    sums = prefix(hashes)
    return first, span_hash(sums, first, first + n)


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (counts[0] of them), starts[1], ..."""
    total = int(counts.sum())
    ends = np.cumsum(counts)
    return np.arange(total) + np.repeat(starts - (ends - counts), counts)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    raw = column.buffers()
    if raw[1] is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(raw[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(raw[2], np.uint8) if raw[2] is not None else np.zeros(0, np.uint8)
    return data, offsets


def blocks(column: pa.Array, size: int = BLOCK) -> Iterator[Block]:
    """Cut a column into blocks of about that many bytes, each of whole documents."""
    data, offsets = buffers(column)
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), n)
        own = offsets[first : last + 1]
        yield Block(data[own[0] : own[-1]], own - own[0], first)
        first = last
    give_back()


def give_back() -> None:
    """Return freed memory to the machine, where the C library can."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
    pa.default_memory_pool().release_unused()


def arrow_schema(schema: str) -> pa.Schema:
    """The Arrow types of a schema given as text."""
    return to_arrow_schema(StructType.fromDDL(schema))


def record_batch(columns: dict, types: pa.Schema) -> pa.RecordBatch:
    """Columns as a batch of the declared types, whatever their values are, or that there are none."""
    arrays = [
        v.cast(kind) if isinstance(v, pa.Array) else pa.array(v, kind) for v, kind in zip(columns.values(), types.types, strict=True)
    ]
    return pa.RecordBatch.from_arrays(arrays, names=types.names)


def map_blocks(
    docs: DataFrame,
    schema: str,
    make: Callable[[], Callable[[Block], dict]],
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One output row per document: the id and the columns that ``make()`` returns for a block.

    ``make`` runs once in each task and gives the function for blocks; ``schema``
    names the columns after the id. The id column keeps its type.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    types = arrow_schema(schema)

    def run(batches):
        work = make()
        for batch in batches:
            ids = batch.column(0)
            for block in blocks(batch.column(1)):
                out = record_batch(work(block), types)
                yield pa.RecordBatch.from_arrays([ids[block.rows], *out.columns], names=[id_col, *types.names])

    return docs.select(id_col, F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"`{id_col}` {kind}, {schema}"
    )


def map_rows(
    docs: DataFrame,
    schema: str,
    make: Callable[[], Callable[[Block, pa.Array], Iterator[dict] | None]],
    id_col: str | None = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Any number of output rows per block: ``make()`` gives a function of block and ids
    that yields dicts of columns, in the schema's order. Without ``id_col`` the ids are nulls.
    """
    types = arrow_schema(schema)

    def run(batches):
        work = make()
        for batch in batches:
            ids = batch.column(0)
            for block in blocks(batch.column(1)):
                for out in work(block, ids[block.rows]) or ():
                    rows = record_batch(out, types)
                    if rows.num_rows:
                        yield rows

    ids = F.lit(None).cast("int").alias("id") if id_col is None else F.col(id_col)
    return docs.select(ids, F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def keep_rows(docs: DataFrame, make: Callable[[], Callable[[Block], np.ndarray]], text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, for which the function of blocks says true."""
    at = docs.columns.index(text_col)

    def run(batches):
        work = make()
        for batch in batches:
            keep = [work(block) for block in blocks(batch.column(at))]
            if keep:
                yield batch.filter(pa.array(np.concatenate(keep)))

    return docs.mapInArrow(run, docs.schema)
