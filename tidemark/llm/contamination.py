"""Benchmark decontamination: size-partitioned MinHash containment search.

Test items are short and documents long, so their Jaccard similarity says
little; what counts is the share of an item's word shingles that a document
holds. Items are partitioned by their number of shingles into classes of
doubling size. In a class of at most u shingles, a document that holds a share
of t misses at most (1 - t) * u of them, so the floor((1 - t) * u) + 1 smallest
hashes of an item, its MinHash sketch, include at least one that the document
holds. Documents look their shingles up in the sketches; an item whose sketch
is met often enough becomes a candidate, and candidates are verified by exact
shingle containment. The search loses nothing at any size.

Words are lower-cased (A-Z) runs of ASCII letters, digits and characters beyond
ASCII. An item of fewer words than a shingle is one shingle of all its words.

Defined results: null or empty items and documents match nothing. Null ids are
kept. Items equal in id and text count once; repeated documents each get rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from math import ceil, floor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .words import ALNUM, LOWER, Block, Words, keep_rows, map_rows

WORD = re.compile(rb"[a-z0-9\x80-\xff]+")
SHINGLE, SHARE = 5, 0.8
#: Bytes of item texts that a pass over the documents searches for.
PASS_BYTES = 8 << 20


def shingles(text: bytes, n: int) -> tuple[int, frozenset]:
    """The shingle length (at most n) and the set of shingles of a lower-case text."""
    words = WORD.findall(text)
    n = min(n, len(words))
    if not n:
        return 0, frozenset()
    return n, frozenset(b" ".join(words[i : i + n]) for i in range(len(words) - n + 1))


class Sketches:
    """MinHash sketches of items, by the length of their shingles."""

    def __init__(self, texts: list[str | None], n: int, share: float):
        self.sets = [shingles((t or "").encode().lower(), n) for t in texts]
        self.need = np.zeros(len(texts), np.int64)
        by_length: dict[int, list] = {}
        for i, (length, own) in enumerate(self.sets):
            if not own:
                continue
            size = len(own)
            upper = (1 << size.bit_length()) - 1  # of the item's size class
            keep = min(size, floor((1 - share) * upper + 1e-9) + 1)
            self.need[i] = keep - min(size - ceil(share * size - 1e-9), keep - 1)
            hashes = np.unique(self._hashes(own, length))
            by_length.setdefault(length, []).append((i, hashes[:keep]))
        self.index = {}
        for length, entries in by_length.items():
            hashes = np.concatenate([h for _, h in entries])
            items = np.repeat([i for i, _ in entries], [len(h) for _, h in entries])
            order = np.argsort(hashes, kind="stable")
            unique, first = np.unique(hashes[order], return_index=True)
            seen = np.zeros(1 << 20, bool)
            seen[(unique & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
            self.index[length] = unique, np.append(first, len(hashes)), items[order], seen

    @staticmethod
    def _hashes(own: frozenset, length: int) -> np.ndarray:
        text = b"\n".join(sorted(own))
        data = np.frombuffer(text, np.uint8)
        lines = np.cumsum([0] + [len(s) + 1 for s in sorted(own)])
        lines[-1] -= 1
        words = Words(Block(data, lines, 0), data, ALNUM)
        return words.grams(length)[1]

    def candidates(self, words: Words) -> np.ndarray:
        """Pairs of document and item whose sketch the document meets often enough."""
        pairs = [np.zeros((0, 2), np.int64)]
        for length, (unique, of, items, seen) in self.index.items():
            first, hashes = words.grams(length)
            maybe = np.flatnonzero(seen[(hashes & np.uint64((1 << 20) - 1)).astype(np.int64)])
            at = np.minimum(np.searchsorted(unique, hashes[maybe]), len(unique) - 1)
            hit = unique[at] == hashes[maybe]
            met = np.unique(np.stack([words.doc[first[maybe[hit]]], at[hit]], 1), axis=0)
            many = np.diff(of)[met[:, 1]]
            ends = np.cumsum(many)
            place = np.arange(int(many.sum())) + np.repeat(of[met[:, 1]] - (ends - many), many)
            found = np.stack([np.repeat(met[:, 0], many), items[place]], 1)
            found, times = np.unique(found, axis=0, return_counts=True)
            pairs.append(found[times >= self.need[found[:, 1]]])
        return np.concatenate(pairs)


def passes(benchmark: DataFrame, item_col: str, text_col: str, pass_bytes: int) -> Iterator[DataFrame]:
    """The distinct items, in as many parts as hold about ``pass_bytes`` of text each."""
    items = benchmark.select(F.col(item_col).alias("item"), F.col(text_col).cast("string").alias("words")).distinct()
    size = items.agg(F.sum(F.coalesce(F.octet_length("words"), F.lit(0)) + 16).cast("long")).first()[0] or 0
    parts = max(1, -(-size // pass_bytes))
    turn = F.pmod(F.xxhash64("item", "words"), F.lit(parts))
    for k in range(parts):
        yield items.where(turn == k).orderBy("item", "words")


def verified(sketches: Sketches, block: Block, share: float) -> Iterator[tuple[int, int, int, int]]:
    """Document, item, shared shingles and the item's shingles of all pairs that hold enough."""
    data = LOWER[block.data]
    pairs = sketches.candidates(Words(block, data, ALNUM))
    known: dict = {}
    for doc, item in pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))].tolist():
        length, own = sketches.sets[item]
        if (doc, length) not in known:
            text = data[block.offsets[doc] : block.offsets[doc + 1]].tobytes()
            known = {(doc, length): shingles(text, length)[1]}
        shared = len(own & known[doc, length])
        if shared >= ceil(share * len(own) - 1e-9):
            yield doc, item, shared, len(own)


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    shingle: int = SHINGLE,
    share: float = SHARE,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    pass_bytes: int = PASS_BYTES,
) -> DataFrame:
    """(document id, item id, n_shared, n_shingles, containment) of all pairs with
    containment of at least ``share``.

    The items are the stated query set: each pass searches all documents for as
    many items as have about ``pass_bytes`` of text.
    """
    found = [search(docs, own, shingle, share, id_col, text_col) for own in passes(benchmark, item_col, item_text_col, pass_bytes)]
    return reduce(DataFrame.unionAll, found).withColumnsRenamed({"doc": id_col, "item": item_col})


def search(docs: DataFrame, items: DataFrame, shingle: int, share: float, id_col: str, text_col: str) -> DataFrame:
    rows = items.collect()  # one pass's items
    ids = pa.array([r.item for r in rows], to_arrow_type(items.schema["item"].dataType))
    texts = [r.words for r in rows]
    doc_kind, item_kind = docs.schema[id_col].dataType.simpleString(), items.schema["item"].dataType.simpleString()

    def make():
        sketches = Sketches(texts, shingle, share)

        def work(block: Block, doc_ids):
            good = list(verified(sketches, block, share))
            if good:
                doc, item, shared, total = map(np.array, zip(*good, strict=True))
                yield {"doc": doc_ids.take(pa.array(doc)), "item": ids.take(pa.array(item)), "n_shared": shared,
                       "n_shingles": total, "containment": shared / total}

        return work

    schema = f"doc {doc_kind}, item {item_kind}, n_shared long, n_shingles long, containment double"
    return map_rows(docs, schema, make, id_col, text_col)


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    shingle: int = SHINGLE,
    share: float = SHARE,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    pass_bytes: int = PASS_BYTES,
) -> DataFrame:
    """The documents, with all their columns, that hold no benchmark item."""
    for items in passes(benchmark, item_col, item_text_col, pass_bytes):
        docs = without(docs, [r.words for r in items.collect()], shingle, share, text_col)
    return docs


def without(docs: DataFrame, texts: list[str | None], shingle: int, share: float, text_col: str) -> DataFrame:
    def make():
        sketches = Sketches(texts, shingle, share)

        def work(block: Block) -> np.ndarray:
            clean = np.ones(len(block), bool)
            clean[[doc for doc, *_ in verified(sketches, block, share)]] = False
            return clean

        return work

    return keep_rows(docs, make, text_col)


ORACLE = r"""
WITH cleaned AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
asked AS (
    SELECT DISTINCT item_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
item_shingles AS (
    SELECT DISTINCT item_id, least(5, len(w)) AS n, array_to_string(w[i:i + least(5, len(w)) - 1], ' ') AS s
    FROM asked, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS t(i) WHERE len(w) > 0),
totals AS (SELECT item_id, count(*) AS n_shingles FROM item_shingles GROUP BY item_id),
lengths AS (SELECT DISTINCT n FROM item_shingles),
doc_shingles AS (
    SELECT DISTINCT doc_id, n, array_to_string(w[i:i + n - 1], ' ') AS s
    FROM cleaned, lengths, unnest(range(1, len(w) - n + 2)) AS t(i) WHERE len(w) >= n),
shared AS (
    SELECT doc_id, item_id, count(*) AS n_shared
    FROM doc_shingles JOIN item_shingles USING (n, s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_shared, n_shingles, n_shared / n_shingles AS containment
FROM shared JOIN totals USING (item_id) WHERE 10 * n_shared >= 8 * n_shingles
"""
