"""Substring deduplication against marking every window, and the suffix array's parts."""

import hashlib
import random

import numpy as np
import pytest

from tidemark.llm import suffixes
from tidemark.llm.suffixes import remove_repeats


def brute(rows, least):
    """(id, n_bytes, n_removed, n_spans, digest) of each row; equal rows are one document."""
    key = lambda r: (r[0] is None, r[0] or 0)
    raw = {r: (r[1] or "").encode() for r in set(rows)}
    first = {}
    for r in sorted(raw, key=key):
        for i in range(len(raw[r]) - least + 1):
            first.setdefault(raw[r][i : i + least], (r, i))
    out = {}
    for r, text in raw.items():
        gone = np.zeros(len(text), bool)
        for i in range(len(text) - least + 1):
            if first[text[i : i + least]] != (r, i):
                gone[i : i + least] = True
        edges = np.flatnonzero(np.diff(np.concatenate(([False], gone)).astype(int)) == 1)
        kept = bytes(np.frombuffer(text, np.uint8)[~gone])
        out[r] = (r[0], len(text), int(gone.sum()), len(edges), hashlib.sha256(kept).hexdigest())
    return sorted((out[r] for r in rows), key=repr)


def result(docs, least):
    got = remove_repeats(docs, least)
    rows = got.collect()
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in rows)
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows), key=repr)


def planted():
    rng = random.Random(11)
    prose = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    passage, short, copy = prose(400), prose(99), prose(700)
    texts = [None, "", "a" * 2000, "ab" * 700, "La " * 90, "lonely is. " * 30, copy, copy, copy + "x", "x" + copy[:350] + "y" + copy[351:], passage]
    for i in range(60):
        parts = [prose(rng.randrange(150))]
        for _ in range(rng.randrange(4)):
            parts += [rng.choice([passage, passage[50:220], passage[:100], passage[:99], short, "a" * 130]), prose(rng.randrange(80))]
        texts.append("".join(parts))
    rng.shuffle(texts)
    return [(3 * i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("rows, size", [(suffixes.SHARD_ROWS, suffixes.SHARD_BYTES), (4, 2000)])
@pytest.mark.parametrize("least", [100, 20])
def test_planted(spark, monkeypatch, rows, size, least):
    monkeypatch.setattr(suffixes, "SHARD_ROWS", rows)
    monkeypatch.setattr(suffixes, "SHARD_BYTES", size)
    data = planted()
    docs = spark.createDataFrame(data, "doc_id long, text string").selectExpr("*", "1 as d", "2 as id", "'x' as packed").repartition(5)
    want = brute(data, least)
    assert sum(r[2] for r in want) > 5000
    assert result(docs, least) == want


def test_odd_ids_and_repeated_rows(spark, nasty):
    """Nulls last; equal rows are one document; texts of one id in a fixed order."""
    rows = [tuple(r) for r in nasty.select("doc_id", "text").collect()]
    assert result(nasty, 100) == brute(rows, 100)


def test_real(real):
    assert result(real, 100) == brute([tuple(r) for r in real.select("doc_id", "text").collect()], 100)


def test_empty_table(nasty):
    assert remove_repeats(nasty.limit(0)).count() == 0


def some_fragments(seed):
    rng = random.Random(seed)
    parts = [bytes(rng.choice(b"ab\x00\xff") for _ in range(rng.randrange(1, 60))) for _ in range(40)]
    parts += [b"a" * 50, b"ab" * 30, parts[0], parts[1] + b"a"]
    ends = np.cumsum([len(p) for p in parts])
    return np.frombuffer(b"".join(parts), np.uint8), ends - [len(p) for p in parts], ends


@pytest.mark.parametrize("seed", range(5))
def test_suffix_array_and_common_prefixes(seed):
    text, begins, ends = some_fragments(seed)
    stop = np.repeat(ends, ends - begins)
    order, rank = suffixes.suffix_array(text, stop)
    suffix = [text[i : stop[i]].tobytes() for i in range(len(text))]
    assert order.tolist() == sorted(range(len(text)), key=lambda i: (suffix[i], i))
    assert (rank[order] == np.arange(len(text))).all()
    shared = suffixes.common_prefixes(text, begins, ends, order, rank, 25)
    for place in range(1, len(order)):
        a, b = suffix[order[place]], suffix[order[place - 1]]
        n = next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))
        assert shared[place] == min(n, 25)


def test_equal_windows_have_equal_anchors():
    """However a passage is embedded, its windows get the same anchors."""
    import pyarrow as pa

    from tidemark.llm.words import blocks

    rng = random.Random(9)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(500))
    seen = []
    for before in ("", "xyz", "q" * 333):
        block = next(blocks(pa.array(["zz", before + passage + "!" * len(before)])))
        low, size, anchor, _ = suffixes.fragments(block, 100)
        of = {int(s) + k - 2 - len(before): a for s, n, a in zip(low, size, anchor, strict=True) for k in range(n & 127)}
        seen.append([of[i] for i in range(401)])
    assert seen[0] == seen[1] == seen[2]
