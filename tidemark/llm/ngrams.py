"""Language-model scores from a sharded n-gram trie in Elias-Fano levels.

The model is an interpolated Witten-Bell bigram model over all training tokens::

    p(w | u) = c(u w) / (c(u) + t(u)) + t(u) / (c(u) + t(u)) * p(w)      p(w) = (c(w) + 1) / (N + V + 1)

with t(u) the number of different tokens seen after u. A text's first token has
p(w). Tokens are the text's words, A-Z in lower case, and one end.

Each block of a few megabytes of text is brought down to its distinct words and pairs,
which go to the shard of their first word. A shard is a range of word hashes. It
builds a trie from the counts of all blocks: level one has the words, their
counts (as running sums) and pointers to their successors, both monotone, and
level two has the successors of one word after the other, each list made to go on where the
last one ended. Words, sums, pointers and successors are Elias-Fano coded; the
two terms of the formula are kept in 16-bit codes of their logarithm. The levels
are written to an unnamed file and mapped. A pair is found by a successor search
relative to the end of the list before its word's. The codes travel back to the block that
asked, which adds up its documents' scores.

Words that hold more than ``1 / HOT`` of all tokens, at most 2 * HOT of them, do not fit in one shard: their
pairs go to the shard of the second word, which keeps counts in place of the first term, and their
sums are added up separately. So no shard depends on how often a word occurs.
Nothing else reaches the driver than those words and the two sums N and V.

Words are 63-bit hashes (two of 10**8 words collide with a probability below
0.001), and 40 of the bits tell the successors of one word apart. A code is off by at most
``10 ** (12 / 131066)``, so a score by 0.0001 per token. Terms below 10**-12 count as that.

Defined results: null and empty texts have one token, their end. Without training
tokens every token has probability one. A null id is kept. Repeated rows are learnt
from as often as they occur. An empty table gives none. A text of any length is
read whole, alone in its block beyond the size of one. Other columns, whatever
their names, are not looked at.
"""

from __future__ import annotations

import mmap
import tempfile
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .elias_fano import EliasFano, from_bytes, to_bytes
from .tables import saved
from .words import LOWER, SOLID, Words, blocks, give_back

#: Bytes of text in a block, pairs a shard has on average at most.
BLOCK_TEXT, SHARD_PAIRS = 1 << 22, 1 << 19
#: A word is hot from this share of all tokens on.
HOT = 256
#: The end of a text; a word has it as its hash with a probability of 2**-63.
END = 0x2A3F19C75D64E80B
KEY_BITS = 40
#: Decades that codes span.
DECADES = 12.0


def quantised(values: np.ndarray) -> np.ndarray:
    """Numbers from 0 to 1 as codes of their logarithm; 0 is 0."""
    out = np.zeros(len(values), np.uint16)
    some = values > 0
    out[some] = np.clip(np.rint(-np.log10(values[some]) * (65533 / DECADES)), 0, 65533) + 1
    return out


def restored(codes: np.ndarray) -> np.ndarray:
    return np.where(codes > 0, 10.0 ** ((1.0 - codes) * (DECADES / 65533)), 0.0)


def squeeze(values: np.ndarray) -> bytes:
    """An array's bytes, those of the same weight together, compressed."""
    data = np.ascontiguousarray(values)
    planes = np.ascontiguousarray(data.view(np.uint8).reshape(len(data), data.itemsize).T).tobytes()
    return len(planes).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def expand(data: bytes, kind) -> np.ndarray:
    kind = np.dtype(kind)
    planes = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(kind.itemsize, -1).T).view(kind).ravel()


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    return ((hashes >> 31) * shards) >> 32


class Trie:
    """Two levels: words with their counts and pointers, and the successors of each."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        level = lambda name: EliasFano.over({k[len(name) + 1 :]: v for k, v in arrays.items() if k.startswith(f"{name}.")})
        self.words, self.sums, self.pointers, self.next = map(level, ("words", "sums", "pointers", "next"))
        self.first = int(arrays["first"][0])
        self.backoff, self.terms = arrays["backoff"], arrays["terms"]

    @staticmethod
    def levels(words, counts, parent, keys, pair_counts, hot) -> dict[str, np.ndarray]:
        """Sorted words with their counts; pairs sorted by number of the first word and key.

        For words marked hot, counts stand in for the formula's first term.
        """
        kinds = np.bincount(parent, minlength=len(words))
        ends = np.cumsum(kinds)
        total = np.maximum(counts + kinds, 1)
        terms = np.where(hot[parent], pair_counts * 10.0**-DECADES, pair_counts / total[parent])
        # each list goes on where the one before ended
        last = np.zeros(len(words), np.int64)
        some = kinds > 0
        last[some] = keys[ends[some] - 1] + 1
        base = np.cumsum(last) - last
        first = words[:1] if len(words) else np.zeros(1, np.int64)
        coded = {
            "words": EliasFano.of(words - first[0]), "sums": EliasFano.of(np.concatenate(([0], np.cumsum(counts)))),
            "pointers": EliasFano.of(np.concatenate(([0], ends))), "next": EliasFano.of(keys + base[parent]),
        }
        arrays = {f"{level}.{k}": v for level, values in coded.items() for k, v in values.arrays().items()}
        backoff = quantised(np.where(hot, 0.0, kinds / total))
        return arrays | {"first": first, "backoff": backoff, "terms": quantised(terms)}

    def find(self, words: np.ndarray) -> np.ndarray:
        """Numbers of words, -1 where they are not in the trie."""
        place, equal = self.words.successor(np.maximum(words - self.first, 0))
        return np.where(equal & (words >= self.first), place, -1)

    def count(self, numbers: np.ndarray) -> np.ndarray:
        out = np.zeros(len(numbers), np.int64)
        known = numbers >= 0
        out[known] = self.sums.get(numbers[known] + 1) - self.sums.get(numbers[known])
        return out

    def successors(self, numbers: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Codes of the first term for pairs, 0 for unseen ones."""
        out = np.zeros(len(numbers), np.uint16)
        some = np.flatnonzero(numbers >= 0)
        begin, end = self.pointers.get(numbers[some]), self.pointers.get(numbers[some] + 1)
        some, begin, end = some[end > begin], begin[end > begin], end[end > begin]
        # what the lists before have used up, from the last of their entries
        base = self._bases(begin)
        place, equal = self.next.successor(base + keys[some])
        hit = equal & (place < end)
        out[some[hit]] = self.terms[place[hit]]
        return out

    def _bases(self, begin: np.ndarray) -> np.ndarray:
        out = np.zeros(len(begin), np.int64)
        later = begin > 0
        out[later] = self.next.get(begin[later] - 1) + 1
        return out


def mapped(arrays: dict[str, np.ndarray]) -> Trie:
    """The levels in an unnamed file, which is gone with the last view of it."""
    with tempfile.TemporaryFile() as file:
        file.write(to_bytes(arrays))
        file.flush()
        return Trie(from_bytes(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)))


# ----------------------------------------------------------------- the blocks


def encoded(docs: DataFrame, learn: Column, id_col: str, text_col: str) -> DataFrame:
    """Blocks of documents: ids, whether they are learnt from, sizes, tokens by number in the block's sorted words."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids, learnt = batch.column(0), batch.column(1).fill_null(False).to_numpy(zero_copy_only=False)
            for part in blocks(batch.column(2), BLOCK_TEXT):
                words = Words(part, LOWER[part.data], SOLID)
                tokens = np.insert((words.hashes >> np.uint64(1)).astype(np.int64), words.of[1:], END)
                listed, tokens, counts = np.unique(tokens, return_inverse=True, return_counts=True)
                heavy = counts * (2 * HOT) >= len(tokens)
                own = ids[part.rows]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block], pa.int64()), pa.ListArray.from_arrays([0, len(own)], own),
                        *(pa.array([squeeze(x)], pa.binary()) for x in (
                            learnt[part.rows].astype(np.uint8), np.diff(words.of) + 1,
                            np.diff(listed, prepend=0), tokens.astype(np.uint32))),
                        pa.array([len(tokens)], pa.int64()),
                        pa.array([[{"h": h, "n": n} for h, n in zip(listed[heavy].tolist(), counts[heavy].tolist(), strict=True)]],
                                 pa.list_(pa.struct([("h", pa.int64()), ("n", pa.int64())]))),
                    ],
                    names=["block", "ids", "learnt", "sizes", "words", "tokens", "n_tokens", "heavy"],
                )
                block += 1

    rows = docs.select(F.col(id_col).alias("id"), learn.cast("boolean").alias("learn"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(
        run,
        f"block long, ids array<{kind}>, learnt binary, sizes binary, words binary, tokens binary, n_tokens long, "
        "heavy array<struct<h:bigint,n:bigint>>",
    )


def hot_words(rows: DataFrame, tokens: int) -> np.ndarray:
    """Hashes of all words with a share of 1 / HOT of the tokens, and of some with half of that.

    A word of that share has half of it in blocks where it is heavy, so the
    heavy ones suffice; there are at most 2 * HOT words of half that share.
    """
    heavy = rows.select(F.explode("heavy").alias("w")).groupBy("w.h").agg(F.sum("w.n").alias("n"))
    found = heavy.where(F.col("n") * (2 * HOT) >= F.lit(tokens)).select("h").collect()
    return np.array(sorted(r["h"] for r in found), np.int64)


class Pairs:
    """A block's distinct pairs of neighbouring tokens, in the order of first and second word's hash."""

    def __init__(self, tokens: np.ndarray, sizes: np.ndarray, size: int):
        self.tokens, self.size = tokens.astype(np.int64), size
        self.ends = np.cumsum(sizes)
        inner = np.ones(len(tokens), bool)
        inner[self.ends - 1] = False
        self.at = np.flatnonzero(inner)  # first tokens of pairs
        pair = self.tokens[self.at] * size + self.tokens[self.at + 1]
        self.pairs, self.number = np.unique(pair, return_inverse=True)
        self.first, self.second = self.pairs // size, self.pairs % size

    def hot_order(self, hot: np.ndarray) -> np.ndarray:
        """Numbers of the pairs whose first word is hot, by second and first word."""
        own = np.flatnonzero(hot[self.first])
        return own[np.lexsort((self.first[own], self.second[own]))]


_QUERY = "shard long, block long, kind int, words binary, counts binary, sizes binary, low binary, high binary, pair_counts binary"
_COLD, _HOT, _LIST = 0, 1, 2


def questions(rows: DataFrame, hot: np.ndarray, shards: int) -> DataFrame:
    """Per block and shard, the words and pairs that belong there, with their training counts."""

    def split(numbers):
        """Runs of equal numbers, which are sorted."""
        cuts = np.flatnonzero(np.diff(numbers)) + 1
        starts = np.concatenate(([0], cuts)) if len(numbers) else np.zeros(0, np.int64)
        return zip(numbers[starts].tolist(), starts.tolist(), [*cuts.tolist(), len(numbers)], strict=False)

    def ask(block, learnt, sizes, words, tokens):
        listed = np.cumsum(expand(words, np.int64))
        sizes = expand(sizes, np.int64)
        pairs = Pairs(expand(tokens, np.uint32), sizes, len(listed))
        weight = np.repeat(expand(learnt, np.uint8), sizes).astype(float)
        own = np.bincount(pairs.tokens, weights=weight, minlength=len(listed)).astype(np.int64)
        counts = np.bincount(pairs.number, weights=weight[pairs.at], minlength=len(pairs.pairs)).astype(np.int64)
        keys = listed & ((1 << KEY_BITS) - 1)
        index = np.minimum(np.searchsorted(hot, listed), max(len(hot) - 1, 0))
        is_hot = hot[index] == listed if len(hot) else np.zeros(len(listed), bool)

        def sent(shard, kind, words, counts, sizes, keys, pair_counts):
            parts = (words, counts, sizes, (keys & 0xFFFFFFFF).astype(np.uint32), (keys >> 32).astype(np.uint8), pair_counts)
            return shard, block, kind, *map(squeeze, parts)

        roots = np.flatnonzero(~is_hot)
        cold = np.flatnonzero(~is_hot[pairs.first])
        starts = np.searchsorted(pairs.first[cold], roots)
        ends = np.searchsorted(pairs.first[cold], roots, "right")
        for shard, a, b in split(shard_of(listed[roots], shards)):
            mine = cold[starts[a] : ends[b - 1]]
            yield sent(shard, _COLD, np.diff(listed[roots[a:b]], prepend=0), own[roots[a:b]], (ends - starts)[a:b],
                       keys[pairs.second[mine]], counts[mine])
        none = np.zeros(0, np.int64)
        ordered = pairs.hot_order(is_hot)
        for shard, a, b in split(shard_of(listed[pairs.second[ordered]], shards)):
            mine = ordered[a:b]
            yield sent(shard, _HOT, index[pairs.first[mine]], none, none, keys[pairs.second[mine]], counts[mine])
        own_hot = np.flatnonzero(is_hot)
        yield sent(block % shards, _LIST, index[own_hot], own[own_hot], own_hot, none, none)

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                made = list(ask(*(c[row].as_py() for c in batch.columns)))
                kinds = [pa.int64(), pa.int64(), pa.int32(), *[pa.binary()] * 6]
                arrays = [pa.array(c, kind) for c, kind in zip(zip(*made, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=[part.split()[0] for part in _QUERY.split(", ")])
            give_back()

    return rows.select("block", "learnt", "sizes", "words", "tokens").mapInArrow(run, _QUERY)


# ----------------------------------------------------------------- the shards

_ANSWER = "shard long, block long, kind int, word long, counts binary, backoff binary, terms binary, n long, kinds long"


def _of_shard(shard: int, rows: list[tuple], hot: np.ndarray) -> Iterator[tuple]:
    """The answers of one shard to all blocks, and its sums."""
    own, first, keys, counts = [], [], [], []
    for _, _, kind, words, word_counts, sizes, low, high, pair_counts in rows:
        if kind == _LIST:
            continue
        words = expand(words, np.int64)
        key = expand(low, np.uint32).astype(np.int64) | expand(high, np.uint8).astype(np.int64) << 32
        listed = np.cumsum(words) if kind == _COLD else np.zeros(0, np.int64)
        own.append((listed, expand(word_counts, np.int64)))
        first.append(np.repeat(listed, expand(sizes, np.int64)) if kind == _COLD else hot[words])
        keys.append(key)
        counts.append(expand(pair_counts, np.int64))
    joined = lambda parts: np.concatenate([*parts, np.zeros(0, np.int64)]).astype(np.int64)
    asked, asked_keys, pair_counts = joined(first), joined(keys), joined(counts)
    asked_words, word_counts = joined([w for w, _ in own]), joined([c for _, c in own])
    # the trie holds what was learnt
    words, number = np.unique(np.concatenate((asked_words[word_counts > 0], asked[pair_counts > 0])), return_inverse=True)
    n_own = int((word_counts > 0).sum())
    total = np.bincount(number[:n_own], weights=word_counts[word_counts > 0], minlength=len(words)).astype(np.int64)
    both = number[n_own:] << KEY_BITS | asked_keys[pair_counts > 0]
    pairs, which = np.unique(both, return_inverse=True)
    sums = np.bincount(which, weights=pair_counts[pair_counts > 0], minlength=len(pairs)).astype(np.int64)
    parent = pairs >> KEY_BITS
    is_hot = np.isin(words, hot)
    trie = mapped(Trie.levels(words, total, parent, pairs & ((1 << KEY_BITS) - 1), sums, is_hot))
    none = squeeze(np.zeros(0, np.uint16))
    # sums: over the words of this shard, and the part of each hot word's successors
    yield shard, -1, -1, -1, none, none, none, int(total.sum()), int((total > 0).sum())
    kinds = np.bincount(parent, minlength=len(words))
    for w in np.flatnonzero(is_hot):
        yield shard, -1, -1, int(np.searchsorted(hot, words[w])), none, none, none, 0, int(kinds[w])
    word_number = trie.find(asked_words)
    seen = trie.count(word_number)
    backoff = np.where(word_number >= 0, trie.backoff[np.maximum(word_number, 0)] if len(words) else 0, 0).astype(np.uint16)
    ask_once, back = np.unique(asked, return_inverse=True)
    terms = trie.successors(trie.find(ask_once)[back], asked_keys)
    at = word_at = part = 0
    for row in rows:
        _, block, kind, hot_index, hot_counts, places, *_ = row
        if kind == _LIST:
            index, learnt = expand(hot_index, np.int64), expand(hot_counts, np.int64)
            for i, n in zip(index.tolist(), learnt.tolist(), strict=True):
                yield shard, -1, -1, i, none, none, none, n, 0
            yield shard, block, kind, -1, squeeze(index), squeeze(expand(places, np.int64)), none, 0, 0
            continue
        n_words, n_pairs = len(own[part][0]), len(keys[part])
        yield (shard, block, kind, -1, squeeze(seen[word_at : word_at + n_words]),
               squeeze(backoff[word_at : word_at + n_words]), squeeze(terms[at : at + n_pairs]), 0, 0)
        at, word_at, part = at + n_pairs, word_at + n_words, part + 1


def _rows(batches) -> Iterator[tuple]:
    for batch in batches:
        columns = batch.columns
        for row in range(batch.num_rows):
            yield tuple(c[row].as_py() for c in columns)


def answers(asked: DataFrame, hot: np.ndarray, shards: int) -> DataFrame:
    """Counts and codes for every question, and rows of sums (without a block)."""
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), *[pa.binary()] * 3, pa.int64(), pa.int64()]
    names = [part.split()[0] for part in _ANSWER.split(", ")]

    def run(batches):
        for shard, rows in groupby(_rows(batches), key=lambda r: r[0]):
            made = list(_of_shard(shard, list(rows), hot))
            for at in range(0, len(made), 512):
                arrays = [pa.array(c, kind) for c, kind in zip(zip(*made[at : at + 512], strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)
            del made
            give_back()

    dealt = asked.repartition(shards, "shard").sortWithinPartitions("shard", "kind", "block")
    return dealt.mapInArrow(run, _ANSWER)


# ----------------------------------------------------------------- the scores


class Sums:
    """N, V, and count and number of successors of every hot word."""

    def __init__(self, rows: list, hot: int):
        self.tokens = self.kinds = 0
        self.count, self.next = np.zeros(hot, np.int64), np.zeros(hot, np.int64)
        for word, n, kinds in rows:
            if word < 0:
                self.tokens, self.kinds = self.tokens + n, self.kinds + kinds
            else:
                self.count[word], self.next[word] = n, kinds
        self.tokens += int(self.count.sum())
        self.kinds += int((self.count > 0).sum())


def block_scores(sizes: np.ndarray, tokens: np.ndarray, size: int, rows: list[tuple], sums: Sums) -> tuple[np.ndarray, ...]:
    """Tokens, known tokens, base score and score of a block's documents.

    ``rows``: (kind, counts, backoff codes, term codes), cold ones by shard, then hot ones by shard, then the list.
    """
    pairs = Pairs(tokens, sizes, size)
    _, index, places, _ = next(r for r in rows if r[0] == _LIST)
    index, places = expand(index, np.int64), expand(places, np.int64)
    hot = np.zeros(size, bool)
    hot[places] = True
    gathered = lambda kind, at, dtype: np.concatenate([np.zeros(0, dtype), *(expand(r[at], dtype) for r in rows if r[0] == kind)])
    count, rest = np.zeros(size, np.int64), np.ones(size)
    count[~hot], count[places] = gathered(_COLD, 1, np.int64), sums.count[index]
    backoff = restored(gathered(_COLD, 2, np.uint16))
    total = sums.count[index] + sums.next[index]
    rest[~hot] = np.where(backoff > 0, backoff, 1.0)
    rest[places] = np.where(sums.count[index] > 0, sums.next[index] / np.maximum(total, 1), 1.0)
    term = np.zeros(len(pairs.pairs))
    term[~hot[pairs.first]] = restored(gathered(_COLD, 3, np.uint16))
    by_hot = pairs.hot_order(hot)
    totals = np.ones(size)
    totals[places] = np.maximum(total, 1)
    term[by_hot] = restored(gathered(_HOT, 3, np.uint16)) * 10.0**DECADES / totals[pairs.first[by_hot]]
    unigram = (count + 1) / (sums.tokens + sums.kinds + 1)
    chance = term + rest[pairs.first] * unigram[pairs.second]
    alone = np.log10(unigram)[pairs.tokens]
    score = alone.copy()
    score[pairs.at + 1] = np.log10(np.minimum(chance, 1.0))[pairs.number]
    starts = pairs.ends - sizes
    add = lambda values: np.add.reduceat(values, starts)
    return sizes, add((count > 0)[pairs.tokens].astype(np.int64)), add(alone), add(score)


def ngram_scores(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores of all documents under a model of those for which ``learn`` is true.

    Columns: the id, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` (the
    unigram's) and ``score``, in log10. One row per row of ``docs``.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    # a written copy: the blocks that ask have to be those that get the answers
    rows = saved(encoded(docs, learn, id_col, text_col), "token-blocks")
    tokens = rows.agg(F.sum("n_tokens")).first()[0] or 0
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(4 * parts, -(-tokens // SHARD_PAIRS))
    hot = hot_words(rows, tokens)
    found = saved(answers(questions(rows, hot, shards), hot, shards), "ngram-answers")
    totals = found.where("kind = -1").groupBy("word").agg(F.sum("n").alias("n"), F.sum("kinds").alias("kinds"))
    sums = Sums([tuple(r) for r in totals.collect()], len(hot))

    asking = rows.select(
        "block", F.lit(-1).alias("kind"), F.lit(-1).cast("bigint").alias("shard"), "ids",
        F.col("sizes").alias("a"), F.col("tokens").alias("b"), F.col("words").alias("c"),
    ).withColumn("c", F.lit(None).cast("binary"))
    given = found.where("kind >= 0").select(
        "block", "kind", "shard", F.lit(None).cast(f"array<{kind}>").alias("ids"),
        F.col("counts").alias("a"), F.col("backoff").alias("b"), F.col("terms").alias("c"),
    )
    together = asking.unionByName(given).repartition("block").sortWithinPartitions("block", "kind", "shard")

    def pieces(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                yield batch.column(0)[row].as_py(), batch, row

    def run(batches):
        for _, group in groupby(pieces(batches), key=lambda p: p[0]):
            ids, asked, got = None, None, []
            for _, batch, row in group:
                of, a, b, c = batch.column(1)[row].as_py(), *(batch.column(k)[row].as_py() for k in (4, 5, 6))
                if of == -1:
                    ids, asked = batch.column(3)[row].values, (expand(a, np.int64), expand(b, np.uint32))
                else:
                    got.append((of, a, b, c))
            size = int(asked[1].max()) + 1
            out = block_scores(*asked, size, got, sums)
            arrays = [pa.array(x, k) for x, k in zip(out, (pa.int64(), pa.int64(), pa.float64(), pa.float64()), strict=True)]
            yield pa.RecordBatch.from_arrays([ids, *arrays], names=["id", "n_tokens", "n_known", "base_score", "score"])
            give_back()

    scored = together.mapInArrow(run, f"id {kind}, n_tokens long, n_known long, base_score double, score double")
    return scored.select(
        F.col("id").alias(id_col), "n_tokens", "n_known", F.lit(sums.tokens).cast("bigint").alias("train_tokens"), "base_score", "score"
    )
