"""The n-gram model against a plain version of its formula, and its Elias-Fano levels."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import jobs, ngrams
from tidemark.llm.elias_fano import EliasFano, from_bytes, to_bytes

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SOLID = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    return [*SOLID.findall((text or "").translate(AZ)), None]


def brute(texts, learnt):
    """(n_tokens, n_known, train_tokens, base, score) of every text."""
    one, two, after = Counter(), Counter(), defaultdict(set)
    for text, own in zip(texts, learnt, strict=True):
        if own:
            ts = tokens(text)
            one.update(ts)
            two.update(zip(ts, ts[1:], strict=False))
    for u, w in two:
        after[u].add(w)
    n, v = sum(one.values()), len(one)
    out = []
    for text in texts:
        ts = tokens(text)
        p1 = [(one[w] + 1) / (n + v + 1) for w in ts]
        score = math.log10(p1[0])
        for i in range(1, len(ts)):
            c, t = one[ts[i - 1]], len(after[ts[i - 1]])
            score += math.log10((two[ts[i - 1], ts[i]] + t * p1[i]) / (c + t) if c else p1[i])
        out.append((len(ts), sum(one[w] > 0 for w in ts), n, sum(map(math.log10, p1)), score))
    return out


def check(docs, got, learn):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = [(i, *x) for (i, _), x in zip(rows, brute([t for _, t in rows], [learn(i) for i, _ in rows]), strict=True)]
    got = [(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got]
    order = lambda r: (r[0] is None, r[0], r[1], round(r[4], 6))
    assert len(got) == len(want)
    for a, b in zip(sorted(got, key=order), sorted(want, key=order), strict=True):
        assert a[:4] == b[:4]
        assert math.isclose(a[4], b[4], rel_tol=1e-9, abs_tol=1e-9)
        assert abs(a[5] - b[5]) <= 1e-4 * a[1] + 1e-9


def fold(i, folds=7):
    return None if i is None else zlib.crc32(str(i).encode()) % folds


@pytest.mark.parametrize("name", ["nasty", "real"])
def test_scores(request, name):
    docs = request.getfixturevalue(name)
    got = ngrams.ngram_scores(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2).collect()
    check(docs, got, lambda i: i is not None and fold(i) != 2)


def test_query_holds_out_its_fold(spark, real):
    got = jobs.op12_ngrams(spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id: r.held_out for r in got} == {r.doc_id: fold(r.doc_id) == 2 for r in real.collect()}
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_blocks_and_shards_do_not_change_results(spark, monkeypatch):
    """Many blocks, words hot and not, one text of most tokens, and texts that are nothing but one word."""
    rng = random.Random(8)
    words = [f"w{int(rng.paretovariate(0.7)) % 3000}" for _ in range(4000)]
    texts = [" ".join(rng.choices(words, k=rng.choice([0, 1, 5, 50]))) for _ in range(300)]
    texts += [" ".join(rng.choices(words, k=20_000)), "hot " * 5000, "hot", "hot hot end", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    learn = F.col("doc_id") % 3 != 0
    got = sorted(tuple(r) for r in ngrams.ngram_scores(docs, learn).collect())
    check(docs, ngrams.ngram_scores(docs.coalesce(1), learn).collect(), lambda i: i % 3 != 0)
    monkeypatch.setattr(ngrams, "SHARD_PAIRS", 500)
    small = sorted(tuple(r) for r in ngrams.ngram_scores(docs, learn).collect())
    assert [r[:4] for r in small] == [r[:4] for r in got]
    assert np.allclose([r[5] for r in small], [r[5] for r in got], atol=1e-9)


def test_nothing_learnt_and_no_rows(spark, nasty):
    got = ngrams.ngram_scores(nasty, F.lit(None)).collect()
    assert {(r.n_known, r.train_tokens, r.base_score, r.score) for r in got} == {(0, 0, 0.0, 0.0)}
    assert ngrams.ngram_scores(nasty.limit(0), F.lit(True)).count() == 0


def test_every_pair_of_a_small_vocabulary(spark):
    texts = ["a b", "a c", "b a a", "c"]
    vocabulary = ["a", "b", "c", "unseen"]
    probes = [(100 + i, f"{u} {w}") for i, (u, w) in enumerate((u, w) for u in vocabulary for w in vocabulary)]
    docs = spark.createDataFrame([*enumerate(texts), *probes], "doc_id long, text string")
    got = {r.doc_id: r.score for r in ngrams.ngram_scores(docs, F.col("doc_id") < 100).collect()}
    want = brute([*texts, *[t for _, t in probes]], [True] * 4 + [False] * len(probes))
    for (i, _), w in zip([*enumerate(texts), *probes], want, strict=True):
        assert abs(got[i] - w[4]) < 1e-3


def test_elias_fano_against_sorted_numbers():
    rng = np.random.default_rng(0)
    for n, most in ((0, 1), (1, 1), (1, 10**18), (5, 3), (1000, 50), (1000, 10**6), (70_000, 1 << 40), (1000, 1 << 62)):
        values = np.sort(rng.integers(0, most, n))
        packed = EliasFano.over(from_bytes(to_bytes(EliasFano.of(values).arrays())))
        assert (packed.get(np.arange(n)) == values).all()
        asked = np.concatenate([values, values + 1, np.maximum(values - 1, 0), rng.integers(0, most, 500), [0, most]])
        place, equal = packed.successor(asked)
        assert (place == np.searchsorted(values, asked)).all() and (equal == np.isin(asked, values)).all()
    values = np.sort(rng.integers(0, 1 << 30, 100_000))
    size = sum(x.nbytes for x in EliasFano.of(values).arrays().values())
    assert size < 100_000 * (3 + np.log2((1 << 30) / 100_000)) / 8 * 1.15


def test_trie_levels_answer_relative_to_their_word():
    words, counts = np.array([5, 9, 70, 900]), np.array([3, 1, 4, 2])
    parent, keys, pairs = np.array([0, 0, 2, 2, 2]), np.array([7, 1 << 39, 0, 7, 8]), np.array([1, 2, 1, 1, 2])
    trie = ngrams.mapped(ngrams.Trie.levels(words, counts, parent, keys, pairs, np.zeros(4, bool)))
    number = trie.find(np.array([5, 9, 70, 900, 4, 6, 1000]))
    assert number.tolist() == [0, 1, 2, 3, -1, -1, -1] and trie.count(number).tolist() == [3, 1, 4, 2, 0, 0, 0]
    for w in range(4):
        own = {int(k): c / (counts[w] + (parent == w).sum()) for p, k, c in zip(parent, keys, pairs, strict=True) if p == w}
        asked = np.array([0, 1, 7, 8, 9, 1 << 39, (1 << 40) - 1])
        got = ngrams.restored(trie.successors(np.full(len(asked), w), asked))
        assert np.allclose(got, [own.get(int(k), 0) for k in asked], rtol=1e-3)
