"""SimHash near-duplicates against all pairs, and the covering code."""

import random
import re

import numpy as np
import pytest
import xxhash

from tidemark.llm import simhash
from tidemark.llm.components import components

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(AZ))
    shingles = [words[i : i + 3] for i in range(len(words) - 2)] if len(words) >= 3 else [words] * bool(words)
    hashes = [xxhash.xxh64(" ".join(s).encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, limit=2):
    """Smallest id reachable, from all pairs of (id, fingerprint)."""
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= limit:
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(prints):
        least.setdefault(find(i), []).append(doc)
    return [min((d for d in least[find(i)] if d is not None), default=None) for i in range(len(prints))]


def expected(docs):
    rows = [(r.doc_id, brute_print(r.text)) for r in docs.select("doc_id", "text").collect()]
    return sorted(
        ((d, f"{p:016x}", c) for (d, p), c in zip(rows, brute_components(rows), strict=True)), key=repr
    )


@pytest.mark.parametrize("name", ["nasty", "real"])
def test_against_all_pairs(request, name):
    docs = request.getfixturevalue(name)
    got = sorted((tuple(r) for r in simhash.simhash_near_duplicates(docs).collect()), key=repr)
    assert got == expected(docs)


def clusters(n=400, seed=3):
    rng = random.Random(seed)
    out = []
    while len(out) < n:
        x = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 2, 30])):
            for _ in range(rng.choice([0, 1, 2, 2, 3, 4])):
                x ^= 1 << rng.randrange(64)
            out.append(x)
    return sorted(set(out))


@pytest.mark.parametrize("threshold", [0, 1, 2, 3])
@pytest.mark.parametrize("hot", [simhash.HOT, 3])
def test_links_lose_nothing(spark, monkeypatch, threshold, hot):
    monkeypatch.setattr(simhash, "HOT", hot)
    monkeypatch.setattr(simhash, "DENSE", 20 if hot == 3 else simhash.DENSE)
    prints = clusters()
    signed = [int(np.uint64(x).astype(np.int64)) for x in prints]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    roots = {r.node: r.root for r in components(simhash.close_links(df, threshold)).collect()}
    groups = {}
    for x, s in zip(prints, signed, strict=True):
        groups.setdefault(roots.get(s, s), set()).add(x)
    want = {}
    for x, c in zip(prints, brute_components([(x, x) for x in prints], threshold), strict=True):
        want.setdefault(c, set()).add(x)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_every_word_has_one_home_and_the_code_covers():
    cover = simhash.Covering(2)
    rng = np.random.default_rng(1)
    prints = rng.integers(0, 1 << 63, 300, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    row, anchor, home = cover.anchors(prints)
    assert np.bincount(row[home]).tolist() == [1] * 300
    for shift in (0, 23):
        part = anchor >> shift & simhash.MASK
        assert not cover.syndrome(part).any()
        far = np.bitwise_count(part ^ (prints[row] >> np.uint64(shift) & np.uint64(simhash.MASK)).astype(np.int64))
        assert far[home].max() <= 3 and far.max() <= 5


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 61)} | {100 + i: 100 for i in range(1, 50)}


def test_empty_table(nasty):
    assert simhash.simhash_near_duplicates(nasty.limit(0)).count() == 0
