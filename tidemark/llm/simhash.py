"""SimHash near-duplicates by anchor-point covering.

Fingerprints are 64-bit votes of hashed word shingles. The anchors are the
words of a covering code: the product of two binary Golay codes over 46 of the
64 bits. The Golay code covers all 23-bit words with radius 3 and no overlap,
so every fingerprint has one home anchor, at most 3 bits away in each block.
Fingerprints are replicated to every anchor within radius plus threshold (the
threshold counts over both blocks), where all fingerprints at most that far
from one that lives there arrive. Each anchor compares its residents with its
visitors, so no link is lost, and links are passed on as stars, so a group of
copies never becomes all of its pairs.

Defined results: a null or empty text, or one without words, has fingerprint
zero and links like any other. A null id is kept and never names a component;
a component of null ids only has the id null. Repeated rows get equal results.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components, unite
from .tables import numbered, saved
from .words import LOWER, SOLID, Block, Cache, map_blocks, ragged

#: The Golay code: length, covering radius, generator polynomial.
LENGTH, RADIUS, GENERATOR = 23, 3, 0b101011100011
MASK = (1 << LENGTH) - 1
#: Residents of an anchor above which they are dealt to several tasks.
HOT = 32_768
#: Pairs compared at a time; visitors from which a resident looks up its neighbours instead.
PAIRS, DENSE = 1 << 22, 70_000


def _spread() -> np.ndarray:
    bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
    return bits.copy().view(np.uint64).ravel()


_SPREAD = _spread()


def vote(hashes: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Per document, the bits set in over half of its hashes ``hashes[of[d]:of[d + 1]]``."""
    n, sizes = len(of) - 1, np.diff(of)
    if not len(hashes):
        return np.zeros(n, np.uint64)
    # eight counters of a byte each in a word: groups of at most 255 hashes of one document
    groups = -(-sizes // 255)
    begins = np.repeat(of[:-1], groups) + 255 * ragged(np.zeros(n, np.int64), groups)
    octets = np.ascontiguousarray(hashes).view(np.uint8).reshape(-1, 8)
    counts = np.empty((len(begins), 64), np.uint8)
    for k in range(8):
        counts[:, 8 * k : 8 * k + 8] = np.add.reduceat(_SPREAD[octets[:, k]], begins).view(np.uint8).reshape(-1, 8)
    totals = np.zeros((n, 64), np.int64)
    np.add.at(totals, np.repeat(np.arange(n), groups), counts)
    bits = 2 * totals > sizes[:, None]
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprints(block: Block, shingle: int = 3) -> np.ndarray:
    """A 64-bit fingerprint of each document of a block."""
    data = LOWER[block.data]
    starts, ends, of = block.spans(SOLID[data])
    sizes = ends - starts
    # all words, one space after each
    places = np.cumsum(sizes + 1)
    text = np.full(int(places[-1]) if len(places) else 0, 0x20, np.uint8)
    begin = places - sizes - 1
    text[ragged(begin, sizes)] = data[ragged(starts, sizes)]
    counts = np.diff(of)
    many = np.where(counts >= shingle, counts - shingle + 1, np.minimum(counts, 1))
    first = ragged(of[:-1], many)
    last = np.minimum(first + shingle, np.repeat(of[1:], many)) - 1
    raw, digest = text.tobytes(), xxhash.xxh64_intdigest
    spans = zip(begin[first].tolist(), (begin[last] + sizes[last]).tolist(), strict=True)
    hashes = np.fromiter((digest(raw[s:e], 42) for s, e in spans), np.uint64, len(first))
    return vote(hashes, np.concatenate(([0], np.cumsum(many))))


class Covering:
    """Golay anchors within radius plus threshold of a word, by the word's syndrome."""

    def __init__(self, threshold: int):
        self.threshold = threshold
        remainder = []
        for bit in range(LENGTH):
            x = 1 << bit
            for high in range(LENGTH - 1, 10, -1):
                if x >> high & 1:
                    x ^= GENERATOR << (high - 11)
            remainder.append(x)
        table = np.zeros((3, 256), np.int64)
        for byte in range(3):
            for value in range(256):
                for bit in range(8):
                    if value >> bit & 1 and 8 * byte + bit < LENGTH:
                        table[byte, value] ^= remainder[8 * byte + bit]
        self.table = table
        # all error words up to that weight, by the excess of their weight over the radius, then syndrome
        self.errors, self.of = [], []
        for excess in range(threshold + 1):
            weights = range(RADIUS + 1) if excess == 0 else [RADIUS + excess]
            words = np.concatenate([self._words(w) for w in weights])
            syndromes = self.syndrome(words)
            order = np.argsort(syndromes, kind="stable")
            self.errors.append(words[order])
            self.of.append(np.searchsorted(syndromes[order], np.arange(2049)))

    @staticmethod
    def _words(weight: int) -> np.ndarray:
        if not weight:
            return np.zeros(1, np.int64)
        bits = np.array(list(combinations(range(LENGTH), weight)), np.int64)
        return (np.int64(1) << bits).sum(axis=1)

    def syndrome(self, words: np.ndarray) -> np.ndarray:
        return self.table[0][words & 255] ^ self.table[1][words >> 8 & 255] ^ self.table[2][words >> 16]

    def anchors(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, anchor and whether it is the row's home, for every anchor of every fingerprint."""
        blocks = [(prints & np.uint64(MASK)).astype(np.int64), (prints >> np.uint64(LENGTH) & np.uint64(MASK)).astype(np.int64)]
        syndromes = [self.syndrome(b) for b in blocks]
        rows, anchors, homes = [], [], []
        every = np.arange(len(prints))
        for low in range(self.threshold + 1):
            for high in range(self.threshold + 1 - low):
                row, parts = every, []
                for word, syndrome, excess in zip(blocks, syndromes, (low, high), strict=True):
                    of = self.of[excess]
                    many = (of[syndrome + 1] - of[syndrome])[row]
                    error = self.errors[excess][ragged(of[syndrome[row]], many)]
                    row = np.repeat(row, many)
                    parts = [np.repeat(p, many) for p in parts] + [word[row] ^ error]
                rows.append(row)
                anchors.append(parts[1] << LENGTH | parts[0])
                homes.append(np.full(len(row), low + high == 0))
        return np.concatenate(rows), np.concatenate(anchors), np.concatenate(homes)


_near = Cache()


def near_words(threshold: int) -> np.ndarray:
    """All 64-bit words of 1 to that many bits."""
    if threshold in _near:
        return _near[threshold]
    bits = np.uint64(1) << np.arange(64, dtype=np.uint64)
    out = [np.array([np.bitwise_or.reduce(bits[list(c)]) for c in combinations(range(64), k)]) for k in range(1, threshold + 1)]
    _near[threshold] = np.concatenate(out) if out else np.zeros(0, np.uint64)
    return _near[threshold]


def links_in_order(group: np.ndarray, prints: np.ndarray, home: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Stars over the fingerprints of sorted groups: each linked one and the smallest of its star."""
    edges = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1], [True])))
    of = np.searchsorted(edges, np.arange(len(group)), "right") - 1
    begin, size = edges[of], np.diff(edges)[of]
    nodes, node = np.unique(prints, return_inverse=True)
    labels = np.arange(len(nodes))
    residents = np.flatnonzero(home & (size > 1))
    dense = size[residents] > DENSE
    # compare residents with the visitors of their anchor, some pairs at a time
    small = residents[~dense]
    cuts = np.searchsorted(np.cumsum(size[small]), np.arange(PAIRS, int(size[small].sum()) + PAIRS, PAIRS), "right")
    for part in np.split(small, np.unique(cuts)):
        left = np.repeat(part, size[part])
        right = ragged(begin[part], size[part])
        close = np.bitwise_count(prints[left] ^ prints[right]) <= threshold
        labels = unite(labels, node[left[close]], node[right[close]])
    # in a large group, look up all near words of a resident among its visitors
    for at in residents[dense]:
        visitors = slice(begin[at], begin[at] + size[at])  # sorted by fingerprint
        near = near_words(threshold) ^ prints[at]
        found = np.minimum(np.searchsorted(prints[visitors], near), size[at] - 1)
        hit = begin[at] + found[prints[visitors][found] == near]
        labels = unite(labels, np.full(len(hit), node[at]), node[hit])
    moved = np.flatnonzero(labels != np.arange(len(nodes)))
    return nodes[moved], nodes[labels[moved]]


def close_links(prints: DataFrame, threshold: int = 2) -> DataFrame:
    """Stars (a, b) that connect all distinct fingerprints ``fp`` at most threshold bits apart."""

    def replicate(batches):
        covering = Covering(threshold)
        for batch in batches:
            values = batch.column(0).to_numpy()
            for at in range(0, len(values), 4096):
                part = values[at : at + 4096]
                row, anchor, home = covering.anchors(part.view(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array(part[row]), pa.array(home)], names=["anchor", "fp", "home"]
                )

    def compare(batches):
        held: list[tuple] = []
        for batch in batches:
            columns = tuple(batch.column(k).to_numpy(zero_copy_only=False) for k in range(4))
            key = columns[0], columns[1]
            # the last group may go on in the next batch
            change = np.flatnonzero((key[0][1:] != key[0][:-1]) | (key[1][1:] != key[1][:-1])) + 1
            joined = bool(held) and held[-1][0][-1] == key[0][0] and held[-1][1][-1] == key[1][0]
            if held and not joined:
                yield from stars(held)
                held = []
            if not len(change):
                held.append(columns)
                continue
            held.append(tuple(c[: change[-1]] for c in columns))
            yield from stars(held)
            held = [tuple(c[change[-1] :] for c in columns)]
        if held:
            yield from stars(held)

    def stars(parts):
        anchor, salt, fp, home = (np.concatenate(c) for c in zip(*parts, strict=True))
        group = np.concatenate(([0], np.cumsum((anchor[1:] != anchor[:-1]) | (salt[1:] != salt[:-1]))))
        a, b = links_in_order(group, fp.view(np.uint64), home, threshold)
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    spark = prints.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = prints.select("fp").repartition(parts).mapInArrow(replicate, "anchor long, fp long, home boolean")
    hot = rows.where("home").groupBy("anchor").count().where(F.col("count") > HOT)
    hot = saved(hot.select("anchor", F.ceil(F.col("count") / HOT).alias("salts")), "hot-anchors")
    if hot.isEmpty():
        rows = rows.withColumn("salt", F.lit(0).cast("bigint"))
    else:
        # residents go to one of their anchor's tasks, visitors to all of them
        rows = rows.join(hot, "anchor", "left").withColumn("salts", F.coalesce("salts", F.lit(1)))
        own = F.pmod(F.xxhash64("fp"), "salts")
        rows = rows.select("anchor", "fp", "home", own.alias("own"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("salts") - 1)).alias("salt"))
        rows = rows.select("anchor", "salt", "fp", (F.col("home") & (F.col("own") == F.col("salt"))).alias("home"))
    rows = rows.select("anchor", "salt", "fp", "home").repartition(parts, "anchor", "salt")
    # unsigned order of the fingerprints
    rows = rows.sortWithinPartitions("anchor", "salt", F.col("fp") < 0, "fp")
    return rows.mapInArrow(compare, "a long, b long").distinct()


def simhash_fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): the fingerprint of every document as a signed long."""

    def make():
        return lambda block: {"fp": pa.array(fingerprints(block, shingle).view(np.int64))}

    return map_blocks(docs, "fp long", make, id_col, text_col)


def simhash_near_duplicates(
    docs: DataFrame, shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: id, ``fingerprint`` (16 hex digits), ``component_id`` (smallest id)."""
    prints = saved(simhash_fingerprints(docs, shingle, id_col, text_col).withColumnRenamed(id_col, "id"), "fingerprints")
    classes = saved(prints.groupBy("fp").agg(F.min("id").alias("least")), "fingerprint-classes")
    roots = components(close_links(classes, max_bits))
    joined = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    joined = saved(joined.select("fp", "least", F.coalesce("root", "fp").alias("root")), "fingerprint-roots")
    smallest = saved(joined.groupBy("root").agg(F.min("least").alias("component_id")), "component-ids")
    # both sides are read from tables, so Spark can split a hot fingerprint
    of_print = saved(joined.join(smallest, "root").select("fp", "component_id"), "fingerprint-components")
    out = prints.join(of_print, "fp")
    return out.select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(
    docs: DataFrame, shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One document of each group, the one of the smallest id; of equal rows one stays."""
    rows, number, shared = numbered(docs, id_col, text_col)
    texts = rows.select(F.col(number).alias("d"), F.col(text_col).alias("text"))
    found = simhash_near_duplicates(texts, shingle, max_bits, "d", "text")
    first = found.where("d = component_id").select(F.col("d").alias(number)).distinct()
    kept = rows.join(first, number, "left_semi")
    return (kept.dropDuplicates([number]) if shared else kept).drop(number)
