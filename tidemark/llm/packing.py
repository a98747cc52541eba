"""Packing along a space-filling curve.

Documents become token ids and a hashed word vector, projected to few
dimensions. Quantiles of each dimension over all documents give grid
coordinates, and the Hilbert curve through the grid gives a key under which
similar documents are neighbours. The documents are range-sorted by it and
packed in that order. Ranges are cut by tokens, not by documents: documents travel
in parts of at most ``PART`` tokens, a part counts by its tokens in the
quantiles that cut the ranges, and cuts may lie within a key and within a
document. A document may be cut, so every sequence is full; what is left at the
end of a task's range is cut into powers of two, which need no padding.

Defined results: a null or empty text is its end token only. Null ids are kept
and repeated rows too. Equal texts have equal keys and lie side by side. An empty
table gives no rows.
"""

from __future__ import annotations

import zlib
from itertools import count, islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import saved
from .words import LOWER, SOLID, Block, Words, byte_class, map_rows, ragged

#: Dimensions and bits of each in the curve's grid.
DIMENSIONS, BITS = 4, 6
END = 1
#: Words whose ids a worker remembers at least before it starts anew.
REMEMBERED = 1_000_000
#: 1 for ASCII letters, 2 for ASCII punctuation but the apostrophe.
_KINDS = byte_class((0x41, 0x5A), (0x61, 0x7A)) + 2 * byte_class(
    (0x21, 0x26), (0x28, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E)
).astype(np.uint8)
#: Tokens of a document that travel together.
PART = 512
#: Bytes of token ids that a task packs at most, in the mean.
TASK_BYTES = 64 << 20
VOCABULARY = "word_bpe_49k.json"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


class Encoder:
    """Token ids of words, remembered by their hashes.

    The tokenizer lower-cases, drops white space and never joins letters with
    punctuation (but for the apostrophe), so a text's ids are those of its pieces
    between white space, and between ASCII letters and punctuation, in lower case.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = {t.content.encode().lower() for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.wide = np.uint32 if self.tokenizer.get_vocab_size() > 1 << 16 else np.uint16
        self.forget()

    def forget(self) -> None:
        self.hashes, self.begins, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, self.wide)

    def words(self, block: Block) -> Words:
        data = LOWER[block.data]
        kind = _KINDS[data]
        return Words(block, data, SOLID, np.flatnonzero(kind[1:] + kind[:-1] == 3) + 1)

    def learn(self, block: Block, words: Words, unique: np.ndarray, first: np.ndarray) -> None:
        """Encode the unique words that are not known yet."""
        if len(self.hashes) > REMEMBERED:
            self.forget()
        at = np.searchsorted(self.hashes, unique)
        known = np.zeros(len(unique), bool)
        inner = at < len(self.hashes)
        known[inner] = self.hashes[at[inner]] == unique[inner]
        new = first[~known]
        if not len(new):
            return
        raw = LOWER[block.data].tobytes()
        spans = zip(words.starts[new].tolist(), words.ends[new].tolist(), strict=True)
        encoded = self.tokenizer.encode_batch_fast([raw[s:e].decode("utf-8", "replace") for s, e in spans], add_special_tokens=False)
        ids = [x.ids for x in encoded]
        counts = np.array([len(x) for x in ids])
        begins = len(self.ids) + np.cumsum(counts) - counts
        self.ids = np.concatenate((self.ids, np.fromiter((i for x in ids for i in x), self.wide, int(counts.sum()))))
        self.hashes = np.insert(self.hashes, at[~known], unique[~known])
        self.begins = np.insert(self.begins, at[~known], begins)
        self.counts = np.insert(self.counts, at[~known], counts)

    def encode(self, block: Block, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a block, each document's closed by the end token, and its offsets."""
        unique, first, inverse = np.unique(words.hashes, return_index=True, return_inverse=True)
        self.learn(block, words, unique, first)
        at = np.searchsorted(self.hashes, unique)
        # the end token is one more word after each document's last
        ids = np.append(self.ids, self.wide(END))
        begins, counts = np.append(self.begins[at], len(self.ids)), np.append(self.counts[at], 1)
        word = np.insert(inverse, words.of[1:], len(unique))
        sizes = counts[word]
        ends = np.cumsum(sizes)[words.of[1:] + np.arange(len(block))]
        ids, ends = ids[ragged(begins[word], sizes)], np.concatenate(([0], ends))
        lower = LOWER[block.data].tobytes()
        if any(a in lower for a in self.added):
            # an added token's text, whatever its case: such documents are encoded whole
            parts = []
            for d in range(len(block)):
                own = ids[ends[d] : ends[d + 1]]
                if any(a in lower[block.offsets[d] : block.offsets[d + 1]] for a in self.added):
                    text = block.text(d).decode("utf-8", "replace")
                    own = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids + [END], self.wide)
                parts.append(own)
            ids, ends = np.concatenate(parts), np.cumsum([0, *map(len, parts)])
        return ids, ends


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of a vocabulary file; later tasks find its words known."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def vectors(words: Words) -> np.ndarray:
    """The mean over a document's words of pseudo-random vectors made from their hashes."""
    parts = words.hashes.copy().view(np.uint16).reshape(-1, 4)[:, :DIMENSIONS]
    sums = np.concatenate((np.zeros((1, DIMENSIONS)), np.cumsum(parts / 65535.0 - 0.5, axis=0)))
    return (sums[words.of[1:]] - sums[words.of[:-1]]) / np.maximum(words.counts, 1)[:, None]


def hilbert(grid: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of each row of grid coordinates."""
    x = grid.astype(np.int64).T.copy()
    n = len(x)
    top = 1 << bits - 1
    q = top
    while q > 1:  # undo excess work of the transposed form
        p = q - 1
        for i in range(n):
            high = (x[i] & q) > 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(high, p, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = top
    while q > 1:
        flip ^= np.where(x[n - 1] & q, q - 1, 0)
        q >>= 1
    x ^= flip
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> bit & 1)
    return key


class Packer:
    """Cuts a stream of documents into full sequences; the rest into powers of two."""

    def __init__(self, length: int, first_sequence: int):
        self.length, self.sequence = length, first_sequence
        self.held: list[tuple] = []  # row number, id, start, ids, tokens of the document
        self.size = 0
        self.out: list[tuple] = []

    def add(self, row: int, doc, start: int, ids: np.ndarray, total: int) -> None:
        self.held.append((row, doc, start, ids, total))
        self.size += len(ids)
        while self.size >= self.length:
            self.close(self.length)

    def close(self, length: int) -> None:
        """Write the first ids held as a sequence of that length."""
        at, last, taken = 0, None, 0
        while at < length:
            row, doc, start, ids, total = self.held[taken]
            piece = ids[: length - at]
            raw = piece.astype("<u4").tobytes()
            if last == (row, start):  # goes on where the piece before it ends
                _, begins, before, crc, _, _, offset = self.out.pop()
                self.out.append((doc, begins, before + len(piece), zlib.crc32(raw, crc), total, self.sequence, offset))
            else:
                self.out.append((doc, start, len(piece), zlib.crc32(raw), total, self.sequence, at))
            at += len(piece)
            last = row, start + len(piece)
            if len(piece) == len(ids):
                taken += 1
            else:
                self.held[taken] = row, doc, start + len(piece), ids[len(piece) :], total
        del self.held[:taken]
        self.size -= length
        self.sequence += 1

    def finish(self) -> None:
        while self.size:
            self.close(1 << self.size.bit_length() - 1)


def tokenized(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per part of a document: its row's number, id, start, ids as bytes, their number, the document's, vector."""
    kind = docs.schema[id_col].dataType.simpleString()

    def make():
        tokens = encoder(vocabulary or default_vocabulary())
        numbers = count(TaskContext.get().partitionId() << 40)

        def work(block: Block, doc_ids):
            words = tokens.words(block)
            ids, ends = tokens.encode(block, words)
            totals = np.diff(ends)
            parts = -(-totals // PART)  # an end token at least, so one part at least
            of = np.repeat(np.arange(len(block)), parts)
            starts = PART * ragged(np.zeros(len(block), np.int64), parts)
            begins = ends[of] + starts
            offsets = np.append(begins, ends[-1]) * ids.itemsize
            values = pa.Array.from_buffers(
                pa.binary(), len(of), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(ids.tobytes())]
            )
            row = np.fromiter(islice(numbers, len(block)), np.int64, len(block))
            vector = vectors(words)[of]
            yield {
                "row": row[of], "id": doc_ids.take(pa.array(of)), "start": starts, "ids": values,
                "n_ids": np.diff(offsets) // ids.itemsize, "total": totals[of],
            } | {f"v{k}": vector[:, k].copy() for k in range(DIMENSIONS)}

        return work

    dims = "".join(f", v{k} double" for k in range(DIMENSIONS))
    return map_rows(docs, f"row long, id {kind}, start long, ids binary, n_ids long, total long{dims}", make, id_col, text_col)


def token_bounds(placed: DataFrame, tokens: int, parts: int) -> np.ndarray:
    """Places that cut the rows into ranges of about equally many tokens.

    A row is repeated once for every ``unit`` of its tokens, the rest decided by a hash, and
    the repetitions' quantiles are the bounds: about 1,000 for each range, and none is shuffled.
    """
    if parts < 2 or not tokens:
        return np.zeros(0)
    unit = max(tokens / (1000 * parts), 1.0)
    chance = F.pmod(F.xxhash64("row", "start"), F.lit(1 << 20)) / (1 << 20)
    times = F.floor(F.col("n_ids") / unit + chance).cast("int")
    repeated = placed.select("place", F.explode(F.array_repeat(F.lit(0), times)))
    shares = [i / parts for i in range(1, parts)]
    found = repeated.agg(F.percentile_approx("place", shares, max(10_000, 10 * parts)).alias("cuts")).first()
    return np.unique(np.array(found["cuts"] or [], float))


def pack(
    docs: DataFrame, length: int = 2048, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``length`` is a power of two.
    """
    wide = encoder(vocabulary or default_vocabulary()).wide
    rows = saved(tokenized(docs, vocabulary, id_col, text_col), "token-ids")
    cuts = [i / (1 << BITS) for i in range(1, 1 << BITS)]
    dims = [f"v{k}" for k in range(DIMENSIONS)]
    first = F.col("start") == 0
    edges = rows.agg(
        F.sum("n_ids").alias("n"), *[F.percentile_approx(F.when(first, F.col(c)), cuts, 2000).alias(c) for c in dims]
    ).first()
    bounds = [np.array(edges[c] or [], float) for c in dims]

    @F.pandas_udf("long")
    def curve(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
        grid = [np.searchsorted(e, v.to_numpy(), "right") for e, v in zip(bounds, (a, b, c, d), strict=True)]
        return pd.Series(hilbert(np.stack(grid, 1), BITS))

    size = (edges["n"] or 0) * np.dtype(wide).itemsize
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // TASK_BYTES))
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches):
        packer = Packer(length, TaskContext.get().partitionId() << 33)
        for batch in batches:
            row, starts, totals = (batch.column(c).to_pylist() for c in ("row", "start", "total"))
            docs_of, values = batch.column("id").to_pylist(), batch.column("ids")
            raw, offsets = np.frombuffer(values.buffers()[2] or b"", wide), np.frombuffer(values.buffers()[1], np.int32)
            offsets = offsets[values.offset : values.offset + len(values) + 1] // np.dtype(wide).itemsize
            for i, doc in enumerate(docs_of):
                packer.add(row[i], doc, starts[i], raw[offsets[i] : offsets[i + 1]], totals[i])
            if packer.out:
                yield rows_of(packer, batch.column("id").type)
        packer.finish()
        if packer.out:
            yield rows_of(packer, batch.column("id").type)

    def rows_of(packer: Packer, id_type: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*packer.out, strict=True))
        packer.out = []
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], id_type), *(pa.array(c, pa.int64()) for c in columns[1:])], names=[id_col, *names]
        )

    # order along the curve; within a key by a hash of the row, within a document by the share before the part
    tie = F.pmod(F.xxhash64("row"), F.lit(1 << 17))
    place = F.col("key") * (1 << 29) + F.col("tie") * (1 << 12) + F.floor(F.col("start") * (1 << 12) / F.col("total"))
    carried = ["row", "id", "start", "ids", "total"]
    placed = rows.select(*carried, "n_ids", curve(*dims).alias("key"), tie.alias("tie"))
    placed = placed.select(*carried, "n_ids", "key", "tie", place.cast("double").alias("place"))
    bounds_of = token_bounds(placed, edges["n"] or 0, parts)

    @F.pandas_udf("int")
    def task(at: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds_of, at.to_numpy(), "right").astype(np.int32))

    ordered = placed.withColumn("task", task("place")).repartitionById(parts, "task")
    ordered = ordered.sortWithinPartitions("key", "tie", "row", "start")
    pieces = ordered.select(*carried).mapInArrow(run, f"`{id_col}` {kind}, " + ", ".join(f"{n} long" for n in names))
    return saved(pieces, "packed")
